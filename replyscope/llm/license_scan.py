"""License labels by phrases and by a positional index of rare words.

A word is a run of characters other than ASCII white space, punctuation and
controls; A-Z count as a-z. Base labels are phrases whose words stand one after
the other.

The method's labels come from notice texts. The index maps every word of the
notices to its postings, (notice, place). For each notice a file's words are
ranked by inverse document frequency, counted over all documents, and the
``RAREST`` rarest of them that the file holds are looked up, unless the file
lacks a word of the notice's key phrases, so that it can't hold them. A word at place p
of the file with a posting at place q of the notice says that the notice starts
at p - q; starts on which most of the looked-up words agree, give or take
``DRIFT`` words, are candidates. A candidate stands if every key phrase of the
notice is found near its own place and at least ``LEAST_SHARE`` of the notice's
words are found in order of place.

Words are compared by 64-bit hashes of their bytes. Documents are scanned in
byte-bounded slices without a shuffle; what is gathered are the document
frequencies of the notices' words, a few hundred numbers."""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _FOLD, hash_spans, map_batches, only, text_bytes

RAREST = 8                     # words of a notice that are looked up in a file
AGREE = 0.5                    # share of them that must agree on a start
DRIFT = 3                      # words by which a place may be off
LEAST_SHARE = 0.7              # of a notice's words found in place
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True

# Phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Notices as their publishers word them, with the phrases that
# must be there for the label to hold.
NOTICES = (
    ("mit",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software.",
     ("permission is hereby granted free of charge", "to deal in the software without restriction",
      "sublicense")),
    ("mit", "Released under the MIT License.", ("released under the mit license",)),
    ("isc",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies.",
     ("for any purpose with or without fee", "permission notice appear in all copies")),
    ("apache-2",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0",
     ("apache license version 2 0", "except in compliance with the license")),
    ("apache-2", "Licensed under the Apache License, Version 2.0.",
     ("licensed under the apache license version 2 0",)),
    ("bsd",
     "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met: Redistributions of source code "
     "must retain the above copyright notice, this list of conditions and the following "
     "disclaimer.",
     ("redistribution and use in source and binary forms", "must retain the above copyright")),
    ("gpl-3",
     "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation, either version "
     "3 of the License, or (at your option) any later version.",
     ("gnu general public license", "published by the free software foundation")),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3.",
     ("gnu general public license", "version 3")),
    ("lgpl",
     "This library is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License as published by the Free Software Foundation",
     ("gnu lesser general public license", "published by the free software foundation")),
    ("mpl-2",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
     "copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/.",
     ("subject to the terms of the mozilla public license", "copy of the mpl")),
    ("cc-by",
     "This work is licensed under the Creative Commons Attribution 4.0 International License.",
     ("creative commons attribution 4 0",)),
    ("cc-by-nc",
     "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 "
     "International License.",
     ("creative commons attribution noncommercial",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", ("licensed under cc by nc 4 0",)),
    ("cc-by-sa",
     "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International "
     "License.",
     ("creative commons attribution sharealike",)),
    ("unlicense",
     "This is free and unencumbered software released into the public domain. Anyone is free to "
     "copy, modify, publish, use, compile, sell, or distribute this software",
     ("free and unencumbered software released into the public domain",)),
)


def words_of(text: str) -> list[str]:
    return WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text))


class FileWords:
    """Words of a slice's texts: ``hash`` of each, and ``first``, the index of
    every text's first word (one more entry at the end)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        raw = _FOLD[raw]
        inside = _IN_WORD[raw]
        before = np.zeros(len(raw), dtype=bool)
        before[1:] = inside[:-1]
        edges = offsets[1:-1]
        before[edges[edges < len(raw)]] = False
        start = np.flatnonzero(inside & ~before)
        self.hash = hash_spans(raw, np.flatnonzero(inside), start)[0]
        self.first = np.searchsorted(start, offsets)


def file_words(texts: list[str]) -> FileWords:
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(d) for d in data])
    return FileWords(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)


# ----------------------------------------------------------------------- index
class Index:
    """Vocabulary of the notices and phrases as sorted hashes; words are then
    numbers, and -1 outside of it. ``postings[word]``: (notice, place)."""

    def __init__(self, notices=NOTICES, phrases=PHRASES):
        texts = [words_of(t) for _, t, _ in notices]
        keys = [[words_of(k) for k in ks] for _, _, ks in notices]
        base = [words_of(p) for p, _ in phrases]
        known = sorted({w for t in [*texts, *base, *(k for ks in keys for k in ks)] for w in t})
        hashes = file_words(known).hash if known else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hash = hashes[order]
        number = {known[o]: i for i, o in enumerate(order)}
        self.labels = [label for label, _, _ in notices]
        self.texts = [np.asarray([number[w] for w in t], dtype=np.int64) for t in texts]
        self.phrases = [(np.asarray([number[w] for w in p], dtype=np.int64), label)
                        for p, (_, label) in zip(base, phrases)]
        # A key phrase has its place in the notice, where it stands first.
        self.keys = [[(k, int(places(t, k)[0])) for k in
                      (np.asarray([number[w] for w in one], dtype=np.int64) for one in ks)]
                     for t, ks in zip(self.texts, keys)]
        self.needed = [np.unique(np.concatenate([k for k, _ in ks])) for ks in self.keys]
        self.postings: list[list[tuple[int, int]]] = [[] for _ in known]
        for n, t in enumerate(self.texts):
            for place, word in enumerate(t.tolist()):
                self.postings[word].append((n, place))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hash, hashes)
        at[at == len(self.hash)] = 0
        return np.where(self.hash[at] == hashes, at, -1) if len(self.hash) \
            else np.full(len(hashes), -1)

    def idf(self, df: np.ndarray, files: int) -> np.ndarray:
        return np.log((files + 1) / (df + 1))


def places(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the phrase's words stand one after the other."""
    n = len(words) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    hit = np.flatnonzero(words[:n] == phrase[0])
    for j in range(1, len(phrase)):
        hit = hit[words[hit + j] == phrase[j]]
    return hit


# ------------------------------------------------------------------------ scan
class Scanner:
    """The index with its words' inverse document frequencies."""

    def __init__(self, index: Index, idf: np.ndarray):
        self.index = index
        # Words of each notice, the rarest first, with their places in it.
        self.rare: list[list[tuple[int, list[int]]]] = []
        for n, text in enumerate(index.texts):
            words = sorted(set(text.tolist()), key=lambda w: (-idf[w], w))
            self.rare.append([(w, [q for m, q in index.postings[w] if m == n]) for w in words])

    def starts(self, n: int, where: dict[int, np.ndarray]) -> list[int]:
        """Candidate starts of a notice in a file, from the places of the
        file's words, best supported first in each run of near ones."""
        looked = [(w, q) for w, q in self.rare[n] if w in where][:RAREST]
        least = max(1, int(np.ceil(AGREE * min(RAREST, len(self.rare[n])))))
        if len(looked) < least:
            return []
        votes = [np.unique((where[w][:, None] - np.asarray(q)).ravel()) for w, q in looked]
        start = np.concatenate(votes)
        word = np.repeat(np.arange(len(votes)), [len(v) for v in votes])
        order = np.argsort(start, kind="stable")
        start, word = start[order], word[order]
        low = np.searchsorted(start, start - DRIFT)
        high = np.searchsorted(start, start + DRIFT, side="right")
        # Enough votes are needed for enough words, so few places are counted.
        found, reach = [], -1
        for i in np.flatnonzero(high - low >= least).tolist():
            if len(set(word[low[i]:high[i]].tolist())) >= least and start[i] > reach:
                near = start[low[i]:high[i]]
                values, times = np.unique(near, return_counts=True)
                found.append(int(values[np.argmax(times)]))
                reach = found[-1] + DRIFT
        return found

    def share(self, n: int, start: int, where: dict[int, np.ndarray]) -> float:
        """Share of a notice's words that a file has near their places."""
        text = self.index.texts[n]
        hits = 0
        for word in set(text.tolist()):
            if word in where:
                wanted = start + np.flatnonzero(text == word)
                near = np.searchsorted(where[word], wanted - DRIFT)
                held = near < len(where[word])
                hits += int((where[word][near[held]] <= wanted[held] + DRIFT).sum())
        return hits / len(text)

    def verified(self, n: int, start: int, words: np.ndarray) -> bool:
        """Whether every key phrase stands near its place."""
        for key, place in self.index.keys[n]:
            low = max(0, start + place - 2 * DRIFT)
            if not len(places(words[low:start + place + len(key) + 2 * DRIFT], key)):
                return False
        return True

    def notices(self, words: np.ndarray, possible: np.ndarray) -> dict[str, float]:
        """Labels of the notices that stand in a file, with the largest share
        found; only ``possible`` notices are looked for."""
        at = np.flatnonzero(words >= 0)
        order = np.argsort(words[at], kind="stable")
        present, lead = np.unique(words[at][order], return_index=True)
        where = dict(zip(present.tolist(), np.split(at[order], lead[1:])))
        found: dict[str, float] = {}
        for n in possible.tolist():
            label = self.index.labels[n]
            for start in self.starts(n, where):
                share = self.share(n, start, where)
                if share >= LEAST_SHARE and self.verified(n, start, words):
                    found[label] = max(found.get(label, 0.0), share)
        return found

    def scan(self, words: np.ndarray, first: np.ndarray) -> dict[str, list]:
        """Labels and counts of a slice's files; ``words`` are numbers or -1.
        Base phrases, and which files hold every word of a notice's key phrases,
        are found for all files together."""
        files = len(first) - 1
        row = np.repeat(np.arange(files), np.diff(first))
        base: list[set[str]] = [set() for _ in range(files)]
        hits = [np.zeros(0, dtype=np.int64)]
        for phrase, label in self.index.phrases:
            at = places(words, phrase)
            at = at[row[at] == row[at + len(phrase) - 1]]
            hits.append(at)
            for r in np.unique(row[at]).tolist():
                base[r].add(label)
        at = np.sort(np.concatenate(hits))
        edges = np.searchsorted(at, first)
        holds = np.zeros((files, len(self.index.hash)), dtype=bool)
        known = words >= 0
        holds[row[known], words[known]] = True
        possible = np.stack([holds[:, needed].all(axis=1) for needed in self.index.needed],
                            axis=1) if self.index.needed else np.zeros((files, 0), dtype=bool)
        found: list[dict[str, float]] = [{} for _ in range(files)]
        for r in np.flatnonzero(possible.any(axis=1)).tolist():
            found[r] = self.notices(words[first[r]:first[r + 1]], np.flatnonzero(possible[r]))
        some = edges[1:] > edges[:-1]
        return {"n_words": np.diff(first).tolist(), "n_base": np.diff(edges).tolist(),
                "first_word": [int(at[s] - f) if m else None
                               for s, f, m in zip(edges, first, some)],
                "last_word": [int(at[e - 1] - f) if m else None
                              for e, f, m in zip(edges[1:], first, some)],
                "base_labels": [",".join(sorted(b)) for b in base],
                "labels": [",".join(sorted(b | set(f))) for b, f in zip(base, found)],
                "score": [max(f.values(), default=0.0) for f in found]}


OUT = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
       "base_labels string, labels string, score double")


def _texts(docs: DataFrame) -> DataFrame:
    return only(docs, doc_id="bigint", text="string")


def document_frequencies(docs: DataFrame, index: Index) -> tuple[np.ndarray, int]:
    """In how many documents each word of the index stands, and how many
    documents there are."""
    def batch(part: pa.RecordBatch, _):
        words = FileWords(*text_bytes(part.column(0)))
        number = index.numbers(words.hash)
        row = np.repeat(np.arange(part.num_rows), np.diff(words.first))
        held = number >= 0
        pairs = np.unique(row[held] * np.int64(len(index.hash) + 1) + number[held])
        df = np.bincount(pairs % (len(index.hash) + 1), minlength=len(index.hash) + 1)
        df[len(index.hash)] = part.num_rows
        some = np.flatnonzero(df)
        return {"word": some, "n": df[some]}

    counted = map_batches(_texts(docs).select("text"), batch, "word int, n bigint", text="text")
    found = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    files = found.pop(len(index.hash), 0)
    return np.asarray([found.get(w, 0) for w in range(len(index.hash))], dtype=np.int64), files


def scan_licenses(docs: DataFrame, notices=NOTICES, phrases=PHRASES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score`` per row of ``docs(doc_id, text)``.

    ``score`` is the largest share of a notice's words that a labelled file has
    in place, 0 where no notice stands. A null or empty text has no words, empty
    labels and score 0. Repeated rows and rows without an id each have a result
    of their own. Of words with the same frequency the smaller hash is looked up
    first. An empty table gives no rows; other columns are ignored."""
    index = Index(notices, phrases)
    df, files = document_frequencies(docs, index)
    idf = index.idf(df, files)

    def batch(part: pa.RecordBatch, scanner: Scanner):
        words = FileWords(*text_bytes(part.column(1)))
        number = index.numbers(words.hash)
        return {"doc_id": part.column(0), **scanner.scan(number, words.first)}

    return map_batches(_texts(docs), batch, OUT, text="text",
                       setup=lambda: Scanner(index, idf))
