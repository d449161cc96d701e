"""Inputs and plain re-computations shared by the tests of this folder."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, n_words string, `doc` string, score string"

WORDS = "amber bolt crane delta ember fjord grain harbor inlet jolt kelp lumen mortar nickel orbit pylon quartz ridge silo tundra".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "er", "ly"]) for _ in range(n))


def frame(spark, texts, ids=None):
    """Documents with further columns whose names operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), "k", "x", "y", "z") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def odd_texts(seed: int = 7) -> list:
    """Null, empty, blank, very long, non-ASCII, repeated and nearly equal texts."""
    rng = random.Random(seed)
    base = sentence(rng, 120)
    out = [None, "", " ", "\n", "\n\n a \n", "A", base, base, base.upper(), base + " end", base.replace("delta", "gamma", 1)]
    out += ["é" * 30 + " " + base[:200], "x" * 3000, "a b c " * 2000, sentence(rng, 20_000), "\0 nul \x1f sep \x85 nel em", "a\r\nb\tc\n"]
    for _ in range(40):
        lines = [sentence(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 8))]
        out.append("\n".join(lines + rng.sample(["All rights reserved.", "  Shared Line ", base[50:250]], rng.randint(0, 3))))
    return out


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text) -> list:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text or ""))
