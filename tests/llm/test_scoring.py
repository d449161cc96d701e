"""Classifiers, neighbours and licence notices: held-out accuracy and brute force."""

import math
import random
from pathlib import Path

import numpy as np
import pytest
from texts import frame, odd_texts, sentence, words
from pyspark.sql import functions as F

from millrace.llm import licenses, neighbours, quality, toxicity
from millrace.llm.text import Words, batches, mix


def labelled_texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text = sentence(rng, rng.randint(20, 300))
        toxic, good = rng.random() < 0.3, rng.random() < 0.7
        if toxic:
            w = text.split()
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(["vilefoe", "scumword", "hatebane"]))
            text = " ".join(w)
        if not good:
            half = len(text) // 2
            text = text[:half] + "\n" + text[half:].upper().replace(" ", "!! ")
        out.append((text, int(good), int(toxic)))
    return out


def test_words_equal_the_pattern():
    texts = [(t or "") for t in odd_texts()]
    for first, run in batches([t.encode() for t in texts], 500):
        found = Words(run)
        for i in range(len(run)):
            span = slice(found.first[i], found.first[i + 1])
            assert [found.data[a:b].decode() for a, b in zip(found.start[span], found.end[span])] == words(texts[first + i])
    assert len(Words([b"", b"--", b""]).hashes()) == 0
    same = Words([b"one two one", b"one"]).hashes()
    assert same[0] == same[2] == same[3] != same[1]


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_learns_and_handles_odd_rows(spark, module, label):
    rows = labelled_texts(600, 1)
    docs = frame(spark, [t for t, _, _ in rows] + odd_texts())
    labels = spark.createDataFrame([(i, q, t) for i, (_, q, t) in enumerate(rows[:400])] + [(3, None, None), (None, 1, 1), (5, rows[5][1], rows[5][2])], "doc_id bigint, quality int, toxic int")
    model = module.learn(docs, labels, label)
    scored = {r.doc_id: r.s for r in docs.select("doc_id", module.score(model, F.col("text")).alias("s")).collect()}
    assert len(scored) == len(rows) + len(odd_texts()) and all(0 <= s <= 1 for s in scored.values())
    truth = [q if label == "quality" else t for _, q, t in rows]
    right = [(scored[i] >= 0.5) == bool(truth[i]) for i in range(400, 600)]
    assert np.mean(right) > 0.95
    # the score of a text does not depend on the rows beside it
    assert model.scores([b""])[0] == pytest.approx(scored[len(rows)]) == pytest.approx(scored[len(rows) + 1])


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels(spark, module):
    docs = frame(spark, ["a", None])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = module.learn(docs, labels)
    assert [r[0] for r in docs.select(module.score(model, F.col("text"))).collect()] == [0.5, 0.5]
    assert frame(spark, []).select(module.score(model, F.col("text"))).count() == 0


def test_weights_are_sparse():
    rows = [np.unique(np.random.default_rng(i).integers(0, 1 << toxicity.BITS, 200)) for i in range(300)]
    rows = [np.append(r[r != 7], 7) if i % 3 == 0 else r[r != 7] for i, r in enumerate(rows)]
    model = toxicity.fit(rows, [int(i % 3 == 0) for i in range(300)])
    assert 7 in model.places and len(model.places) < 3000


def test_ftrl_equals_a_plain_learner():
    """Row by row and place by place, with nothing but dictionaries."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 400, 30)) for _ in range(120)]
    labels = [int(5 in r or rng.random() < 0.1) for r in rows]
    alpha, beta, l1, l2 = 0.7, 1.5, 0.6, 0.2
    z, n, bias, bias_n = {}, {}, 0.0, 0.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(3):
        for row, label in zip(rows, labels):
            w = {int(i): weight(int(i)) for i in row}
            error = 1 / (1 + math.exp(-(sum(w.values()) + bias))) - label
            for i, old in w.items():
                sigma = (math.sqrt(n.get(i, 0.0) + error**2) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + error - sigma * old
                n[i] = n.get(i, 0.0) + error**2
            bias_n += error**2
            bias -= alpha / (beta + math.sqrt(bias_n)) * error
    model = toxicity.fit(rows, labels, 3, alpha, beta, l1, l2)
    want = {i: weight(i) for i in z if weight(i)}
    assert model.bias == pytest.approx(bias) and model.places.tolist() == sorted(want) and 0 < len(want) < 400
    assert model.weights.tolist() == pytest.approx([want[i] for i in sorted(want)], rel=1e-5)


def test_calibration_of_scores():
    """Unseen rows of a rare sign score on their side, and in their share."""
    rng = np.random.default_rng(8)
    rows = [np.unique(np.append(rng.integers(1000, 1 << toxicity.BITS, 40), rng.choice([1, 2, 3, 4], 2) if i % 8 == 0 else 500)) for i in range(1600)]
    labels = [int(i % 8 == 0) for i in range(1600)]
    plain = toxicity.fit(rows[:800], labels[:800])
    model = toxicity.calibrate(plain, rows[:800], labels[:800])
    table = np.zeros(1 << toxicity.BITS)

    def caught(m):
        table[:] = 0
        table[m.places] = m.weights
        p = 1 / (1 + np.exp(-np.clip([m.bias + table[r].sum() for r in rows[800:]], -35, 35)))
        return (p[::8] >= 0.7).mean(), (np.delete(p, slice(None, None, 8)) >= 0.7).mean()

    assert caught(model)[0] >= max(0.95, caught(plain)[0]) and caught(model)[1] < 0.01
    few = toxicity.calibrate(plain, rows[:30], labels[:30])
    assert few is plain


def test_toxic_score_equals_a_plain_sum():
    rng = random.Random(17)
    texts = [t.encode() if t is not None else None for t in odd_texts()]
    every = np.unique(np.concatenate([toxicity.features(Words([t or b""]))[1] for t in texts])).astype(np.int64)
    kept = np.array(sorted(rng.sample(every.tolist(), 500)))
    model = toxicity.Model(kept, np.array([rng.gauss(0, 0.3) for _ in kept], np.float32), -0.2)
    weight = dict(zip(kept.tolist(), model.weights.tolist()))
    for text, score in zip(texts, model.scores(texts)):
        w = words((text or b"").decode())
        single = {x: int(h >> np.uint64(64 - toxicity.BITS)) for x, h in zip(w, Words([text or b""]).hashes())}
        places = set(single.values())
        for gap, factor in ((1, toxicity._PAIR), (2, toxicity._SKIP)):
            for a, b in zip(w, w[gap:]):
                h = [Words([x.encode()]).hashes() for x in (a, b)] if len(w) < 300 else None
                if h:
                    places.add(int(mix(h[0] * factor + h[1])[0] >> np.uint64(64 - toxicity.BITS)))
        if len(w) < 300:  # every pair hashed on its own takes long
            assert score == pytest.approx(1 / (1 + math.exp(-(model.bias + sum(weight.get(p, 0.0) for p in places)))), rel=1e-5)


def test_attention_equals_a_plain_forward_pass():
    """One passage after another, each weight by its formula."""
    rng = np.random.default_rng(5)
    model = quality.Model(rng.normal(size=quality.SIZE), rng.uniform(0.5, 2, quality.SIZE))
    model.weights["classify"], model.weights["bias"] = rng.normal(size=24), np.array([0.3])
    w = model.weights
    texts = [t.encode() if t is not None else None for t in odd_texts()]
    for text, score in zip(texts, model.scores(texts)):
        x, _ = quality.passages([text])
        vectors, powers = [], []
        for row in x:
            unit = [min(8, max(-8, (row[i] - model.mean[i]) / model.scale[i])) for i in range(quality.SIZE)]
            v = [math.tanh(sum(unit[i] * w["encode"][i, j] for i in range(quality.SIZE)) + w["shift"][j]) for j in range(24)]
            logit = 0.0
            for g in range(len(w["attend"])):
                t = math.tanh(sum(v[j] * w["tanh"][j, g] for j in range(24)))
                gate = 1 / (1 + math.exp(-sum(v[j] * w["gate"][j, g] for j in range(24))))
                logit += t * gate * w["attend"][g]
            vectors.append(v)
            powers.append(math.exp(logit))
        bag = sum(p * np.array(v) for p, v in zip(powers, vectors)) / sum(powers)
        assert score == pytest.approx(1 / (1 + math.exp(-(float(bag @ w["classify"]) + 0.3))), abs=1e-6)


def test_quality_gradient():
    rng = np.random.default_rng(0)
    model = quality.Model(np.zeros(quality.SIZE), np.ones(quality.SIZE))
    model.weights["classify"] = rng.normal(size=24)
    x, first, y = rng.normal(size=(9, quality.SIZE)), np.array([0, 2, 3, 9]), np.array([1.0, 0, 1])

    def loss():
        p = model.forward(x, first)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, d in model.gradient(x, first, y).items():
        w = model.weights[name]
        at = tuple(rng.integers(0, s) for s in w.shape)
        w[at] += 1e-6
        up = loss()
        w[at] -= 2e-6
        assert (up - loss()) / 2e-6 == pytest.approx(d[at], abs=1e-6)
        w[at] += 1e-6


def brute_neighbours(rows, k):
    rows = list(dict(rows).items())
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in sorted({i for i in ids.tolist() if i % 50 == 0}):
        v = x[np.flatnonzero(ids == q)[0]]
        s = (x * v).sum(1) / (np.sqrt((v * v).sum()) * np.sqrt((x * x).sum(1)))
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, v string").repartition(4)


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[rng.integers(20)] + rng.normal(size=16) * 0.4).astype(np.float32).tolist()) for i in range(4000)]
    got = {}
    for r in neighbours.search(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = brute_neighbours(rows, 5)
    assert got.keys() == want.keys()
    found = total = 0
    for q, top in want.items():
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        assert [s for _, s in sorted(got[q].values(), key=lambda x: (-x[1], x[0]))] == [got[q][i][1] for i in range(1, 6)]
        total += 5
        found += len({i for i, _ in top} & {i for i, _ in got[q].values()})
        truth = dict(top)
        assert all(s == pytest.approx(truth[i], abs=1e-12) for i, s in got[q].values() if i in truth)
    assert found / total >= 0.9


def test_neighbours_ties_copies_and_bad_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [1.0, 2.0]) for i in range(0, 400, 10)]
    bad = [(1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (6, [1.0, None]), (7, [1.0]), (None, [1.0, 1.0]), (550, [0.0, 0.0])]
    rows = same + [(5, [2.0, 1.0]), (500, [2.0, 1.0]), (500, [2.0, 1.0])]
    got = {}
    for r in neighbours.search(vectors(spark, rows + bad), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_neighbours(rows, 5)
    assert {q: [v for _, v, _ in sorted(x)] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    few = vectors(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])])
    assert [tuple(r) for r in neighbours.search(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 0.0)]
    assert neighbours.search(vectors(spark, bad[:2]), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(0, 2000, 5)]
    monkeypatch.setattr(neighbours, "RECALL", 1.0)
    got = {(r.query_id, r["rank"]): r.vec_id for r in neighbours.search(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()}
    assert got == {(q, i + 1): v for q, top in brute_neighbours(rows, 5).items() for i, (v, _) in enumerate(top)}


def test_toxicity_learns_from_whole_long_texts(spark, monkeypatch):
    rng = random.Random(12)
    texts = [sentence(rng, rng.choice([20, 5_000])) + (" vilefoe" if i % 2 else "") for i in range(30)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, toxic int")
    monkeypatch.setattr(toxicity, "fit", lambda rows, labels: [(tuple(r.tolist()), y) for r, y in zip(rows, labels)])
    monkeypatch.setattr(toxicity, "calibrate", lambda model, rows, labels: model)
    every = toxicity.learn(docs, labels)
    whole = [tuple(np.unique(toxicity.features(Words([t.encode()]))[1]).tolist()) for t in texts]
    assert sorted(every) == sorted((p, i % 2) for i, p in enumerate(whole))
    most = sum(len(p) for p, _ in every[:7]) + 1
    monkeypatch.setattr(toxicity, "FIT_PLACES", most)
    assert toxicity.learn(docs, labels) == every[:7]
    monkeypatch.setattr(toxicity, "FIT_PLACES", 1)
    assert toxicity.learn(docs, labels) == every[:1]
    # a text that does not fit is passed over, the rest goes on
    short = [e for e in every if len(e[0]) < 200]
    monkeypatch.setattr(toxicity, "FIT_PLACES", sum(len(p) for p, _ in short))
    assert 3 < len(short) < 27 and toxicity.learn(docs, labels) == short
    monkeypatch.setattr(toxicity, "FIT_PLACES", 1 << 24)
    doubled = toxicity.learn(docs.union(docs.where("doc_id % 3 = 0")), labels)
    assert doubled == every  # a repeated row counts once


def test_labels_with_clashing_columns(spark):
    """Columns of the labels named like what the operators make inside."""
    rng = random.Random(31)
    texts = [sentence(rng, 30) + (" vilefoe vilefoe" if i % 2 else "") for i in range(120)]
    docs = frame(spark, texts)
    plain = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id bigint, y int")
    clashing = spark.createDataFrame([(i, i % 2, "l", "n", "p", "t", "o") for i in range(120)], "doc_id bigint, y int, label string, n string, places string, text string, `order` string")
    for module in (toxicity, quality):
        a, b = module.learn(docs, plain, "y"), module.learn(docs, clashing, "y")
        assert np.array_equal(a.scores([t.encode() for t in texts]), b.scores([t.encode() for t in texts]))


def test_quality_is_fitted_on_all_passages(spark, monkeypatch):
    rng = random.Random(13)
    texts = [sentence(rng, rng.choice([20, 6_000])) for _ in range(12)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id bigint, quality int")
    monkeypatch.setattr(quality, "fit", lambda x, sizes, y: (x, sizes.tolist(), y.tolist()))
    x, sizes, y = quality.learn(frame(spark, texts), labels)
    bags = [quality.passages([t.encode()])[0].astype(np.float32) for t in texts]
    assert max(sizes) > 32 and sorted(sizes) == sorted(map(len, bags)) and len(x) == sum(sizes)
    got = np.split(x, np.cumsum(sizes)[:-1])
    assert all(any(g.shape == b.shape and np.allclose(g, b, atol=1e-5) for b in bags) for g in got)
    monkeypatch.setattr(quality, "FIT_PASSAGES", sum(sizes[:5]))
    few = quality.learn(frame(spark, texts), labels)
    assert few[1] == sizes[:5] and few[2] == y[:5] and np.array_equal(few[0], x[: sum(sizes[:5])])


def test_calibration_leaves_out_the_own_row(spark, monkeypatch):
    rng = np.random.default_rng(14)
    x = neighbours._unit(rng.normal(size=(300, 12)))
    tree = neighbours.Tree(x, leaf_rows=8)
    leaf = tree.leaves(x)
    sizes = np.bincount(leaf, minlength=tree.n_leaves)
    rows = [(i, v.tolist(), int(n)) for i, (v, n) in enumerate(zip(x, leaf))]
    placed = spark.createDataFrame(rows, "vec_id bigint, v array<double>, leaf bigint")
    classes = placed.where("vec_id % 5 = 0").selectExpr("vec_id as class", "v")
    depth = []
    for q in range(0, 300, 5):
        near = x @ x[q]
        near[q] = -2
        depth.append(tree.walk(tree.matrix @ x[q], sizes, tree.n_leaves, 0).index(leaf[near.argmax()]) + 1)
    want = sorted(depth)[29]

    def visits(classes, placed):
        some, true = neighbours._true_leaves(classes, placed, 1)
        return neighbours._calibrate(some, true, tree, sizes, 0.5)

    assert want > 1 and visits(classes, placed) == want
    assert visits(classes.where("class = 0"), placed.where("vec_id = 0")) == 1


@pytest.mark.parametrize("recall", [0.97, 1.0])
def test_leaves_stay_bounded(spark, monkeypatch, recall):
    """A head fitted on few rows; its leaves are cut where they are, twice."""
    for name, value in {"FIT_ROWS": 60, "LEAF_LIMIT": 60, "LEAF_FIT": 40, "FAN": 4, "BLOCK": 50, "RECALL": recall}.items():
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(21)
    centres = rng.normal(size=(12, 10))
    rows = [(i, (centres[rng.integers(12)] + rng.normal(size=10) * 0.5).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, [float(i + 1)] * 10) for i in range(150)]  # many of one direction, which nothing parts
    levels, cut = [], neighbours._place_all

    def placed(*args):
        out = cut(*args)
        levels.append(len(out[1]))
        sizes = [r["count"] for r in out[0].groupBy("leaf").count().collect()]
        assert sum(n > 60 for n in sizes) <= 1
        return out

    monkeypatch.setattr(neighbours, "_place_all", placed)
    got = {}
    for r in neighbours.search(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert levels[0] >= 2
    want = brute_neighbours(rows, 5)
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hit = sum(len({i for i, _ in top} & {i for i, _ in got[q].values()}) for q, top in want.items() if q < 2000)
    assert hit / sum(5 for q in want if q < 2000) >= (0.9 if recall < 1 else 0.999)


def brute_base(text):
    w, places, labels = words(text), [], set()
    for phrase, label in licenses.BASE.items():
        key = phrase.split()
        for i in range(len(w) - len(key) + 1):
            if w[i : i + len(key)] == key:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licences(spark):
    rng = random.Random(9)
    texts = odd_texts() + ["cc by", "CC-BY cc by-nc", "all rights all rights reserved reserved", "General Public License, general public license"]
    notices = [t for _, _, t in licenses.TEMPLATES]
    for i in range(40):
        w = sentence(rng, 50).split()
        w.insert(rng.randrange(50), notices[i % len(notices)].title())
        texts.append(" ".join(w))
    ids = [None, *range(1, len(texts))]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, texts, ids)).collect()}
    for i, t in zip(ids, texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(t)
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")
    for i in range(40):
        assert licenses.TEMPLATES[i % len(notices)][0] in got[len(texts) - 40 + i].labels.split(",")
    assert licenses.scan(frame(spark, [])).count() == 0
    assert got[2].labels == ""


def brute_notices(index, text):
    """Labels and best coverage over every start whose key phrase stands."""
    w, labels, best = words(text), set(), 0.0
    weight = dict(zip(licenses.VOCABULARY, index.idf.tolist()))
    for label, phrase, notice in licenses.NOTICES:
        notice, key = notice.split(), phrase.split()
        at = next(i for i in range(len(notice)) if notice[i : i + len(key)] == key)
        for i in range(len(w) - len(key) + 1):
            if w[i : i + len(key)] == key:
                there = sum(weight[x] for k, x in enumerate(notice) if 0 <= i - at + k < len(w) and w[i - at + k] == x)
                covered = there / sum(weight[x] for x in notice)
                if covered >= licenses.COVERED:
                    labels.add(label)
                    best = max(best, covered)
    labels |= set(brute_base(text)[4].split(",")) - {""}
    return ",".join(sorted(labels)), 1.0 if brute_base(text)[1] else best


def test_whole_licence_texts(spark):
    """Whole texts as comments, wrapped anew, with a year and a name before."""
    texts, want = [], []
    folder = Path(licenses.__file__).parent / "notices"
    for file in sorted(folder.glob("*.txt")):
        label, _, text = file.read_text().split("\n", 2)
        flat = text.split()
        lines = [" ".join(flat[i : i + 9]) for i in range(0, len(flat), 9)]
        texts += ["Copyright (c) 2020 A. Person\n" + "\n".join("# " + x for x in lines), " * ".join(lines[: len(lines) * 9 // 10]), " ".join(flat[: len(flat) // 4])]
        want += [label, label, None]
    assert len(want) >= 30
    got = {r.doc_id: r for r in licenses.scan(frame(spark, texts)).collect()}
    for i, label in enumerate(want):
        labels = set(got[i].labels.split(",")) - {"", "gpl"} if label not in (None, "gpl") else set(got[i].labels.split(","))
        if label is not None:
            assert label in labels and labels <= {label, "mit" if label == "bsl-1.0" else label}, (label, got[i].labels)


def test_licences_of_files_with_many_licence_words():
    notices = [t for _, _, t in licenses.TEMPLATES]
    rng = random.Random(10)
    every = list(licenses.VOCABULARY)
    texts = [" ".join(notices), "released under the mit license " + " ".join(every), " x ".join([notices[0], notices[1], notices[11]])]
    # the end of a notice in a text of its own, after a text with its beginning
    texts += ["licensed under the apache license", notices[0].removeprefix("licensed under the apache license ")]
    for _ in range(40):
        parts = [rng.sample(every, 30)]
        for notice in rng.choices(notices, k=4):
            parts += [[x if rng.random() < 0.85 else "z" for x in notice.split()], rng.sample(every, 5)]
        texts.append(" ".join(x for p in parts for x in p))
    for seed in range(4):  # equal, rising and mixed weights
        n = len(licenses.VOCABULARY)
        index = licenses.Index([np.zeros(n), np.arange(n), *np.random.default_rng(seed).integers(0, 900, (2, n))][seed], 1000)
        for text, row in zip(texts, index.scan([t.encode() for t in texts])):
            labels, score = brute_notices(index, text)
            assert row[5] == labels and row[6] == pytest.approx(score)
        # a notice with gaps around its phrase
        part = "licensed z z apache license version 2 0 z z z use this file except in compliance z the license"
        assert index.scan([part.encode()])[0][5] == brute_notices(index, part)[0]
