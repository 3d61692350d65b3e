"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

A text is the run of its words (letters and digits, lower case) in shingles of
three.  Windows of eight shingles begin at every fourth, so any five shingles
on end lie in one.  Templates are cut into segments of at most five.  A band is one
min-hash, the least of the shingle hashes after an exclusive or with the band's
number; there are as many as make a missed segment rarer than ``MISS``.  A template
of which a window shares a band is held against the text: the share of its
shingles found there must reach the threshold.

Only DataFrame functions are used, and each row is scanned by itself: there is no
join and no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 3
WINDOW = 8
STRIDE = 4
SEGMENT = WINDOW - STRIDE + 1
THRESHOLD = 0.8
MISS = 1e-3
SEED = 31

# Common license statements.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingle_hashes(word: Column) -> Column:
    """Hash of every run of three words; empty for fewer."""
    at = F.sequence(F.lit(0), F.size(word) - SHINGLE)
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(SHINGLE)]))
    return F.when(F.size(word) >= SHINGLE, hashed).otherwise(F.array().cast("array<bigint>"))


def n_bands(shortest: int, threshold: float) -> int:
    """Bands with which a window misses a segment of ``shortest`` shingles, found
    to the share ``threshold``, with a probability below ``MISS``."""
    similarity = max(1, math.floor(threshold * shortest)) / WINDOW
    return math.ceil(math.log(MISS) / math.log(1 - similarity))


def template_hashes(spark: SparkSession, templates: Mapping[str, str]) -> dict[str, list[int]]:
    """Shingle hashes of every template, in order; the templates are a parameter and few."""
    rows = spark.createDataFrame(list(templates.items()), "name string, text string")
    found = rows.select("name", shingle_hashes(words(F.col("text"))).alias("h")).collect()
    short = [r.name for r in found if not r.h]
    if short:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    return {r.name: r.h for r in found}


def segments(hashes: list[int]) -> list[list[int]]:
    """A template in parts of about equal length, none longer than a window is sure to hold."""
    n = math.ceil(len(hashes) / SEGMENT)
    cuts = [round(k * len(hashes) / n) for k in range(n + 1)]
    return [hashes[a:b] for a, b in zip(cuts, cuts[1:])]


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``license``, ``containment`` and ``first_word`` of every template found in a row of ``docs`` (doc_id, text).

    ``containment`` is the share of the template's distinct shingles in the
    text, ``first_word`` where the first of these stands (from 0).  A NULL or empty text
    and one under three words holds none.  Repeated rows are found each by
    itself, a NULL doc_id stays NULL; other columns are ignored; an empty table
    gives no row.
    """
    known = template_hashes(docs.sparkSession, templates)
    parts = {name: segments(h) for name, h in known.items()}
    bands = n_bands(min(len(s) for own in parts.values() for s in own), threshold)
    flips = np.random.default_rng(SEED).integers(-(1 << 63), (1 << 63) - 1, bands, dtype=np.int64).tolist()
    # The bands' values differ by their number, so one set holds them all.
    mins = {name: [[min(h ^ f for h in s) for f in flips] for s in own] for name, own in parts.items()}

    def signature(window: Column) -> list[Column]:
        return [F.least(*[F.get(window, F.lit(i)).bitwiseXOR(F.lit(f)) for i in range(WINDOW)]) for f in flips]

    def strikes(window: Column) -> Column:
        """True if a band of the window is that of a template's segment."""
        own = signature(window)
        wanted = [sorted({s[k] for segs in mins.values() for s in segs}) for k in range(bands)]
        return reduce(lambda a, b: a | b, [m.isin(w) for m, w in zip(own, wanted)])

    longs = lambda values: F.array(*[F.lit(v) for v in values])
    # A column read in a lambda is read elsewhere too, or the optimizer would
    # compute it anew in every turn; for the same reason no row is filtered by these columns.
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("word"))
    rows = rows.select("doc_id", shingle_hashes(F.col("word")).alias("h"))
    starts = F.sequence(F.lit(0), F.floor((F.size("h") - 1) / STRIDE).cast("int"))
    cut = F.when(F.size("h") > 0, F.transform(starts, lambda j: F.slice("h", j * STRIDE + 1, WINDOW)))
    hits = F.filter(cut, strikes)
    seen = F.flatten(F.transform(hits, lambda w: F.array(*signature(w))))
    rows = rows.select("doc_id", "h", F.array_distinct(seen).alias("seen"))
    retrieved = [F.when(F.arrays_overlap("seen", longs(sorted({v for s in mins[name] for v in s}))),
                        F.struct(F.lit(name).alias("name"), longs(list(dict.fromkeys(known[name]))).alias("hashes")))
                 for name in sorted(known)]
    rows = rows.select("doc_id", "h", F.explode(F.array_compact(F.array(*retrieved))).alias("t"))
    rows = rows.select("doc_id", F.col("t.name").alias("license"), F.size("t.hashes").alias("n"), "h",
                       F.array_intersect("t.hashes", "h").alias("common"))
    first = F.array_min(F.transform("common", lambda x: F.array_position("h", x))) - 1
    return (rows.select("doc_id", "license", (F.size("common") / F.col("n")).alias("containment"), first.alias("first_word"))
            .where(F.col("containment") >= threshold))
