"""License scan with a positional rare-token index.

Templates (short phrases and longer notices) are posted as word -> (template,
position).  A first pass counts in how many documents each licence word stands;
in a file that has all words of a notice's key phrases, the rarest of the
notice's words that stand in the file are looked up, their postings give relative
positions (place in the file minus place in the template), and a template is
taken where its rare words agree on one relative position and its mandatory
key phrases stand word for word.  For a phrase every word is mandatory, so
looking up its rarest word at each of its places in the file misses no place.

Defined results: null or empty text has no words, no places, empty labels and
score 0; a null id stays null; repeated rows give repeated results; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlake.llm.common import rows_of, ship_package, text_bytes

# Phrases and their labels (fixed values).
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Opening words of well-known notices, the label, and the phrases that must
# stand in them word for word (fixed values).
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction", "mit", ["hereby granted free of charge"]),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd", ["redistribution and use", "source and binary forms"]),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl", ["free software foundation"]),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", "apache", ["apache license"]),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl",
     ["mozilla public license"]),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc", ["permission to use copy modify"]),
    ("this is free and unencumbered software released into the public domain", "unlicense",
     ["free and unencumbered software"]),
]
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")    # the contract's word class on lower-cased UTF-8 bytes
RARE = 8          # rarest words of a notice, of those in the file, that vote for a relative position
SHIFT = 3         # words that an edit may move later words by
AGREE = 0.7       # share of the voting words that must agree
IN_PLACE = 0.5    # share of a notice's words that must be in place where fewer words than AGREE * RARE agree

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()),
])


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased."""
    return WORD.findall(text.lower())


class LicenseIndex:
    """Positional postings of the templates' rarest words."""

    def __init__(self, idf: dict[bytes, float], phrases=PHRASES, notices=NOTICES):
        split = lambda s: s.encode().split()
        self.phrases = [(split(p), label) for p, label in phrases]
        self.notices = [(split(t), label, [split(k) for k in keys]) for t, label, keys in notices]
        rarity = lambda w: idf.get(w, math.inf)
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for i, (ws, _) in enumerate(self.phrases):
            rarest = max(range(len(ws)), key=lambda k: (rarity(ws[k]), -k))
            self.postings[ws[rarest]].append((i, rarest))
        # a notice's places by word, rarest word first, and the words of its key phrases
        self.votes: list[dict[bytes, list[int]]] = []
        self.keys = []
        for ws, _, keys in self.notices:
            self.votes.append({w: [k for k, x in enumerate(ws) if x == w]
                               for w in sorted(set(ws), key=lambda w: (-rarity(w), w))})
            self.keys.append(frozenset(w for key in keys for w in key))
        self.words = frozenset(self.postings).union(*self.votes)

    def places(self, words: list[bytes], at: dict[bytes, list[int]]) -> list[tuple[int, int]]:
        """(start, phrase) of every place where a phrase stands."""
        out = set()
        for w in at:
            for i, k in self.postings.get(w, ()):
                ws = self.phrases[i][0]
                out |= {(p - k, i) for p in at[w] if p >= k and words[p - k:p - k + len(ws)] == ws}
        return sorted(out)

    def notices_in(self, words: list[bytes], at: dict[bytes, list[int]]) -> list[tuple[str, float]]:
        """(label, share of its words in place) of every notice found."""
        found = []
        for i, (ws, label, keys) in enumerate(self.notices):
            if not self.keys[i].issubset(at):
                continue
            rarest = [w for w in self.votes[i] if w in at][:RARE]
            needed = max(2, math.ceil(AGREE * len(rarest)))
            by_start: dict[int, set[bytes]] = defaultdict(set)
            for w in rarest:
                for k in self.votes[i][w]:
                    for p in at[w]:
                        by_start[p - k].add(w)
            best = 0.0
            for s in by_start:
                near = set().union(*(by_start.get(s + d, ()) for d in range(-SHIFT, SHIFT + 1)))
                if len(near) < needed:
                    continue
                window = words[max(0, s - SHIFT):s + len(ws) + SHIFT]
                if all(any(window[j:j + len(key)] == key for j in range(len(window))) for key in keys):
                    share = sum((Counter(ws) & Counter(window)).values()) / len(ws)
                    if share >= IN_PLACE or len(near) >= AGREE * RARE:
                        best = max(best, share)
            if best:
                found.append((label, best))
        return found

    def scan(self, words: list[bytes]) -> tuple:
        """The result columns after doc_id."""
        present = self.words.intersection(words)
        if not present:
            return len(words), 0, None, None, "", "", 0.0
        at: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            if w in present:
                at[w].append(p)
        base = self.places(words, at)
        more = self.notices_in(words, at)
        names = {self.phrases[i][1] for _, i in base}
        return (len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                ",".join(sorted(names)), ",".join(sorted(names | {x for x, _ in more})),
                1.0 if base else max((s for _, s in more), default=0.0))


def licence_idf(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> dict[bytes, float]:
    """Inverse document frequency of each licence word over all documents."""
    vocabulary = frozenset(w for t in [p[0] for p in phrases] + [n[0] for n in notices] for w in t.encode().split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, Counter()
        for batch in batches:
            for raw in batch.column(0):
                n += 1
                df.update(vocabulary.intersection(words_of(raw.as_py())))
        rows = [("", n)] + [(w.decode(), c) for w, c in df.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64())],
                                         names=["word", "n"])

    counts = docs.select(text_bytes("text").alias("text")).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()    # one row per licence word
    df = {r["word"]: r["n"] for r in counts}
    total = df.get("", 0)
    return {w: math.log((1 + total) / (1 + df.get(w.decode(), 0))) for w in vocabulary}


def scan_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """SCHEMA for every document."""
    ship_package(docs.sparkSession)
    index = LicenseIndex(licence_idf(docs, phrases, notices), phrases, notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in rows_of(whole):
                out = [(i, *index.scan(words_of(raw)))
                       for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                if out:
                    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), types)], names=SCHEMA.fieldNames())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text")) \
        .mapInArrow(run, SCHEMA)
