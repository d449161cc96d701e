"""Licence notices in documents, by a positional index of rare licence words.

Notices are one-sentence forms (``TEMPLATES``) and whole licence texts and file
headers (``notices/``: label, key phrase, text). The index holds, for each, its ``INDEXED`` words of
highest inverse document frequency with their positions, and as many more as
it takes that no start with fewer than two of them in place can be covered to
``COVERED``. Frequencies are counted over all documents. Every place of every
indexed word votes for the (notice, start) that would put the notice's word
there. Where two votes meet, the notice's key phrase must stand at its place
in the same text, word by word, and the weight of all words in place is the
notice's coverage. Notices covered to ``COVERED`` or more give their label.

The base phrases are found wherever they stand: each is looked up by its
rarest word, at every place of it, and verified.

Cases: null and empty texts have no words. Rows with the same or a null
doc_id are scanned like others and each counts in the frequencies. No rows
give no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millrace.llm.text import Words, batches

# Base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices: label, key phrase, words
TEMPLATES = [
    ("apache-2.0", "apache license", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("bsd", "source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "cc by", "licensed under cc by 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc0", "cc0 1 0", "cc0 1 0 universal public domain dedication"),
    ("gpl", "general public license", "free software you can redistribute it under the terms of the gnu general public license"),
    ("isc", "use copy modify and or distribute", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "lesser general public license", "under the terms of the gnu lesser general public license"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved", "copyright all rights reserved"),
    ("unlicense", "released into the public domain", "free and unencumbered software released into the public domain"),
]
INDEXED = 8
COVERED = 0.6


def _whole_notices() -> list[tuple[str, str, str]]:
    """Label, key phrase and words of the texts in ``notices/``."""
    out = []
    folder = resources.files(__package__) / "notices"
    for file in sorted(folder.iterdir(), key=lambda f: f.name):
        if file.name.endswith(".txt"):
            label, phrase, text = file.read_text(encoding="ascii").split("\n", 2)
            words = Words([text.encode()])
            out.append((label, phrase, b" ".join(words.data.split()).decode()))
    return out


NOTICES = TEMPLATES + _whole_notices()


def _hash_of(words: Sequence[str]) -> np.ndarray:
    found = Words([" ".join(words).encode()])
    return found.hashes()


VOCABULARY = sorted({w for _, _, text in NOTICES for w in text.split()} | {w for p in BASE for w in p.split()})


def _numbered(hashes: np.ndarray, vocabulary: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Vocabulary number of each word, -1 for others."""
    at = np.minimum(np.searchsorted(vocabulary, hashes, sorter=order), len(vocabulary) - 1)
    number = order[at]
    return np.where(vocabulary[number] == hashes, number, -1)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each word of ``VOCABULARY``, and all documents.
    Tasks send one row per word; the table has as many rows as words."""
    vocabulary = _hash_of(VOCABULARY)
    order = np.argsort(vocabulary)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, rows = np.zeros(len(vocabulary), np.int64), 0
        for frame in frames:
            rows += len(frame)
            for _, run in batches(frame["text"].tolist()):
                words = Words(run)
                number = _numbered(words.hashes(), vocabulary, order)
                known = number >= 0
                once = np.unique(words.text[known].astype(np.int64) * len(vocabulary) + number[known])
                out += np.bincount(once % len(vocabulary), minlength=len(vocabulary))
        yield pd.DataFrame({"word": np.arange(-1, len(out)), "n": np.concatenate([[rows], out])})

    counted = docs.select(F.col("text").cast("binary").alias("text")).mapInPandas(count, "word int, n bigint")
    found = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return np.array([found.get(i, 0) for i in range(len(VOCABULARY))], np.int64), found.get(-1, 0)


@dataclass
class Notice:
    label: str
    words: list[int]  # vocabulary numbers
    phrase: list[int]
    phrase_at: int


class Index:
    """Postings of the rarest words of every notice."""

    def __init__(self, frequencies: np.ndarray, documents: int):
        self.idf = np.log((documents + 1) / (frequencies + 1)) + 1e-3
        self.vocabulary = _hash_of(VOCABULARY)
        self.order = np.argsort(self.vocabulary)
        self.spelled = [w.encode() for w in VOCABULARY]
        number = {w: i for i, w in enumerate(VOCABULARY)}
        self.notices, postings = [], []
        for label, phrase, text in NOTICES:
            words, key = [number[w] for w in text.split()], [number[w] for w in phrase.split()]
            at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
            self.notices.append(Notice(label, words, key, at))
            rare = sorted(range(len(words)), key=lambda i: (-self.idf[words[i]], i))
            postings += [(words[i], len(self.notices) - 1, i) for i in rare[: self._enough(self.idf[[words[i] for i in rare]])]]
        postings.sort()
        self.post = np.array(postings, np.int64)
        self.post_begin = np.searchsorted(self.post[:, 0], np.arange(len(VOCABULARY) + 1))
        self.indexed = np.diff(self.post_begin) > 0
        self.base = []
        for phrase, label in BASE.items():
            key = [number[w] for w in phrase.split()]
            anchor = max(range(len(key)), key=lambda i: self.idf[key[i]])
            self.base.append((label, key, anchor))

    @staticmethod
    def _enough(weights: np.ndarray) -> int:
        """How many of a notice's words, heaviest first, are indexed: with one
        of them and all others in place it is not covered. Or all: then the
        key phrase alone, of two words or more, gives two votes."""
        n = min(INDEXED, len(weights))
        while n < len(weights) and weights[0] + weights[n:].sum() >= (COVERED - 1e-9) * weights.sum():
            n += 1
        return n

    def _stands(self, words: Words, number: np.ndarray, start: int, key: list[int]) -> bool:
        """Whether the words of ``key`` stand from ``start`` in one text."""
        stop = start + len(key)
        if start < 0 or stop > len(number) or words.text[start] != words.text[stop - 1] or number[start:stop].tolist() != key:
            return False
        spans = zip(words.start[start:stop].tolist(), words.end[start:stop].tolist())
        return all(words.data[a:b] == self.spelled[k] for (a, b), k in zip(spans, key))

    def scan(self, texts: Sequence[bytes | None]) -> list[tuple]:
        out = []
        for _, run in batches(texts):
            out += self._scan(Words(run), len(run))
        return out

    def _scan(self, words: Words, n: int) -> list[tuple]:
        number = _numbered(words.hashes(), self.vocabulary, self.order)
        places: list[list[int]] = [[] for _ in range(n)]
        base: list[set[str]] = [set() for _ in range(n)]
        labels: list[set[str]] = [set() for _ in range(n)]
        score = [0.0] * n
        for label, key, anchor in self.base:
            for at in np.flatnonzero(number == key[anchor]).tolist():
                if self._stands(words, number, at - anchor, key):
                    text = int(words.text[at])
                    places[text].append(at - anchor - int(words.first[text]))
                    base[text].add(label)
                    score[text] = 1.0
        for text, notice, start in self._meetings(words, number):
            entry = self.notices[notice]
            if not self._stands(words, number, start + entry.phrase_at, entry.phrase):
                continue
            low, high = max(start, int(words.first[text])), min(start + len(entry.words), int(words.first[text + 1]))
            weights = self.idf[entry.words]
            there = np.zeros(len(entry.words), bool)
            there[low - start : high - start] = number[low:high] == np.array(entry.words)[low - start : high - start]
            covered = float(weights[there].sum() / weights.sum())
            if covered >= COVERED:
                labels[text].add(entry.label)
                score[text] = max(score[text], covered)
        sizes = np.diff(words.first).tolist()
        return [
            (sizes[i], len(p), min(p, default=None), max(p, default=None), ",".join(sorted(base[i])), ",".join(sorted(base[i] | labels[i])), min(1.0, score[i]))
            for i, p in enumerate(places)
        ]

    def _meetings(self, words: Words, number: np.ndarray) -> list[tuple[int, int, int]]:
        """``(text, notice, start)`` on which two or more indexed words agree,
        with the words of the key phrase in place."""
        at = np.flatnonzero((number >= 0) & self.indexed[number])
        if not len(at):
            return []
        text, word = words.text[at], number[at]
        size = self.post_begin[word + 1] - self.post_begin[word]
        each = np.repeat(np.arange(len(at)), size)
        post = self.post[np.repeat(self.post_begin[word] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        # one number for text, notice and start, which may lie before the text
        room = max(len(entry.words) for entry in self.notices)
        width = len(number) + room
        votes = (text[each].astype(np.int64) * len(self.notices) + post[:, 1]) * width + at[each] - post[:, 2] + room
        votes, n = np.unique(votes, return_counts=True)
        of, start = np.divmod(votes[n >= 2], width)
        text, notice = np.divmod(of, len(self.notices))
        start -= room
        # most meetings are of common words: their key phrases are looked at together
        met = np.zeros(len(start), bool)
        for i, entry in enumerate(self.notices):
            mine = np.flatnonzero(notice == i)
            low = start[mine] + entry.phrase_at
            inside = (low >= words.first[text[mine]]) & (low + len(entry.phrase) <= words.first[text[mine] + 1])
            mine, low = mine[inside], low[inside]
            met[mine] = np.all([number[low + k] == w for k, w in enumerate(entry.phrase)], axis=0)
        return list(zip(text[met].tolist(), notice[met].tolist(), start[met].tolist()))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score`` of every row."""
    index = Index(*document_frequencies(docs))
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = pd.DataFrame(index.scan(frame["text"].tolist()), columns=columns)
            found["first_word"], found["last_word"] = found["first_word"].astype("Int64"), found["last_word"].astype("Int64")
            yield pd.concat([frame[["doc_id"]].reset_index(drop=True), found], axis=1)

    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = rows.mapInPandas(find, "doc_id string, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
