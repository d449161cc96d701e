"""Document quality by attention over passages, learned from document labels.

A text is cut into passages of about ``PASSAGE`` bytes. Each passage becomes
numbers (shares of character classes, repetition and lengths of words), an
encoder turns them into a vector, and a gated attention, the product of a
tanh and a sigmoid branch, gives each passage a weight. The weighted sum of
the vectors is scored. Only documents carry labels; which passages matter is
learned with the rest.

Fitting uses at most ``FIT_ROWS`` labelled rows, those of the smallest doc_id
hash, each with all its passages; of these, in that order, all that fit into
``FIT_PASSAGES`` passages together. It runs on the driver. Scoring covers
every row and all its passages, a run of texts at a time.

Cases: null and empty texts are one passage of zeros. Labels that are null
are left out; a doc_id labelled more than once has the label of at least half
of them. With no usable label the score is 0.5. Rows with the same or a null
doc_id are scored like others. Columns other than doc_id and text are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import SPACED_BYTES, Words, batches
from millrace.llm.toxicity import labelled, whole_rows

PASSAGE = 512
FIT_ROWS = 6_000
FIT_PASSAGES = 192_000
EPOCHS = 30
SCORED_BYTES = 1 << 22  # texts whose passages are held at once; a longer text is a run of its own


def _classes() -> np.ndarray:
    """Class of each byte: every ASCII mark its own, kinds of letters, digits,
    and high bytes by their upper bits."""
    out, names = np.zeros(256, np.int64), {}
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            name = f"high{b >> 4}"
        elif c.isdigit():
            name = "digit"
        elif c.isalpha():
            name = "upper" if c.isupper() else c if c in "aeiou" else "lower"
        elif b < 0x20 and c not in "\t\n\r":
            name = "control"
        else:
            name = c
        out[b] = names.setdefault(name, len(names))
    return out


_CLASS = _classes()
_N_CLASSES = int(_CLASS.max()) + 1
_N_WORD = 9
SIZE = _N_CLASSES + _N_WORD


def passages(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of every passage, and the first passage of each text."""
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    parts = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(parts)])
    out = np.zeros((first[-1], SIZE), np.float32)
    for at, run in batches(texts):
        _fill(out[first[at] : first[at + len(run)]], run, parts[at : at + len(run)])
    return out, first


def _fill(out: np.ndarray, texts: list[bytes], parts: np.ndarray) -> None:
    n = len(out)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])  # texts stand one byte apart
    data = np.frombuffer(b" ".join(texts), np.uint8)
    if not len(data):
        return
    text = np.repeat(np.arange(len(texts)), sizes + 1)[: len(data)]
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    width = -(-np.maximum(sizes, 1) // parts)
    place = np.arange(len(data)) - begins[text]
    passage = first[text] + np.minimum(place // width[text], parts[text] - 1)
    own = place < sizes[text]  # not the byte between two texts
    count = np.bincount((passage * _N_CLASSES + _CLASS[data])[own], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    out[:, :_N_CLASSES] = np.sqrt(count / np.maximum(1, count.sum(1, keepdims=True)))

    words = Words(texts, SPACED_BYTES)
    h = words.hashes()
    if not len(h):
        return
    mine = passage[words.start]
    each = np.bincount(mine, minlength=n)
    safe = np.maximum(1, each)
    size = words.end - words.start

    def share(values: np.ndarray, of: np.ndarray = mine) -> np.ndarray:
        return np.bincount(of, values, minlength=n) / safe

    order = np.lexsort((h, mine))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (mine[order][1:] != mine[order][:-1])
    cols = [np.log1p(each), share(size) / 8, share(size > 20), share(new, mine[order])]
    for lag in (1, 2):
        again = (h[lag:] == h[:-lag]) & (words.text[lag:] == words.text[:-lag])
        cols.append(share(again, mine[lag:]))
    by_text = np.lexsort((h, words.text))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[by_text][1:] != h[by_text][:-1]) | (words.text[by_text][1:] != words.text[by_text][:-1])
    seen = np.bincount(words.text[by_text], fresh, minlength=len(texts)) / np.maximum(1, np.diff(words.first))
    owner = np.repeat(np.arange(len(texts)), parts)
    cols += [seen[owner], np.log1p(np.diff(words.first))[owner] / 4, np.minimum(1, share(size * size) / 400)]
    out[:, _N_CLASSES:] = np.stack(cols, 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Model:
    """Encoder, gated attention and classifier."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, width: int = 24, gates: int = 12, seed: int = 1):
        random = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale

        def start(*shape: int) -> np.ndarray:
            return random.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.weights = {
            "encode": start(SIZE, width), "shift": np.zeros(width), "tanh": start(width, gates), "gate": start(width, gates),
            "attend": start(gates), "classify": np.zeros(width), "bias": np.zeros(1),
        }

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w, owner = self.weights, np.repeat(np.arange(len(first) - 1), np.diff(first))
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        e = np.tanh(x @ w["encode"] + w["shift"])
        t, g = np.tanh(e @ w["tanh"]), _sigmoid(e @ w["gate"])
        logit = (t * g) @ w["attend"]
        power = np.exp(logit - np.maximum.reduceat(logit, first[:-1])[owner])
        a = power / np.add.reduceat(power, first[:-1])[owner]
        z = np.add.reduceat(a[:, None] * e, first[:-1])
        p = _sigmoid(z @ w["classify"] + w["bias"])
        return {"x": x, "e": e, "t": t, "g": g, "a": a, "z": z, "p": p, "owner": owner}

    def gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, first)
        owner, e, t, g, a = f["owner"], f["e"], f["t"], f["g"], f["a"]
        ds = (f["p"] - y) / len(y)
        dz = (ds[:, None] * w["classify"])[owner]
        da = (dz * e).sum(1)
        dlogit = a * (da - np.add.reduceat(a * da, first[:-1])[owner])
        dtg = dlogit[:, None] * w["attend"]
        dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
        de = (a[:, None] * dz + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - e * e)
        return {
            "encode": f["x"].T @ de, "shift": de.sum(0), "tanh": e.T @ dt, "gate": e.T @ dg,
            "attend": (t * g).T @ dlogit, "classify": f["z"].T @ ds, "bias": ds.sum(keepdims=True),
        }

    def scores(self, texts: Sequence[bytes | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for at, run in batches(texts, SCORED_BYTES):
            x, first = passages(run)
            out[at : at + len(run)] = self.forward(x, first)["p"]
        return out


def fit(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.005, decay: float = 1e-4) -> Model:
    """Adam over documents; ``x`` holds their passages one after another."""
    if not len(y):
        return Model(np.zeros(SIZE), np.ones(SIZE))
    model = Model(x.mean(0), x.std(0) + 0.01)
    random, step = np.random.default_rng(2), 0
    begin = np.concatenate([[0], np.cumsum(sizes)])
    m = {k: np.zeros_like(v) for k, v in model.weights.items()}
    v = {k: np.zeros_like(w) for k, w in model.weights.items()}
    epochs = max(epochs, -(-600 * batch // len(y)))  # few labels: more rounds over them
    for _ in range(epochs):
        order = random.permutation(len(y))
        for i in range(0, len(y), batch):
            some = order[i : i + batch]
            n = sizes[some]
            rows = np.repeat(begin[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
            step += 1
            for k, d in model.gradient(x[rows], np.concatenate([[0], np.cumsum(n)]), y[some]).items():
                d = d + decay * model.weights[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                model.weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = FIT_ROWS) -> Model:
    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x, first = passages(frame["text"].tolist())
            numbers = [x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:])]
            yield frame.drop(columns="text").assign(n=np.diff(first), numbers=numbers)

    found = labelled(docs, labels, label, limit).select("doc_id", "text", "label")
    rows = whole_rows(found.mapInPandas(extract, "doc_id bigint, label int, n bigint, numbers binary"), "numbers", "n", FIT_PASSAGES, limit)
    x = np.frombuffer(b"".join(rows["numbers"]), np.float32).reshape(-1, SIZE)
    return fit(x, rows["n"].to_numpy(np.int64), rows["label"].to_numpy(float))


def score(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return of(text.cast("binary"))
