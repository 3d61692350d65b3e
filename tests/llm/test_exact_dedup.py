"""Exact duplicates against brute force, with good and with poor digests."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from runlens.llm import exact_dedup

LONG = "long text " * 30_000
ROWS = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "A"), (None, "a"), (None, "q"), (None, "q"), (9, LONG), (10, LONG),
        (10, LONG), (11, LONG + " "), (12, "a\n"), (13, "é"), (14, "é")] + [(100 + i, "copy") for i in range(900)]
# Columns of the operator's own names.
EXTRA = ["row", "digest", "keep_id", "salt", "group_size", "text_sha256", "whole", "d", "t"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(7)
    return df.withColumns({c: F.lit("x") for c in EXTRA})


def expected():
    best, size, left = {}, Counter(), {}
    for i, t in ROWS:
        t = t or ""
        size[t] += 1
        best[t] = max(-1 if i is None else i, best.get(t, -1))
    out = []
    for i, t in ROWS:
        t = t or ""
        keep = None if best[t] == -1 else best[t]
        kept = i == keep and left.setdefault(t, True)
        if kept:
            left[t] = False
        out.append((i, keep, size[t], kept, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def poor(n):
    return lambda text: F.pmod(F.crc32(text.cast("binary")), F.lit(n)).cast("string").cast("binary")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, poor(1), poor(3)], ids=["sha256", "one digest", "three digests"])
def test_groups_against_brute_force(docs, digest):
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)
                  for r in exact_dedup.exact_groups(docs, digest).collect())
    assert got == expected()


@pytest.mark.parametrize("share", [2, 10_000])
def test_hot_groups_by_both_joins(docs, share, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
    rows = exact_dedup.exact_groups(docs).collect()
    assert len(rows) == len(ROWS) and sum(r.kept for r in rows) == len({t or "" for _, t in ROWS})
    assert {r.keep_id for r in rows if r.group_size == 900} == {999}


def test_deduplicate_keeps_all_columns(docs):
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert Counter(r.text or "" for r in rows) == Counter({t or "" for _, t in ROWS})
    assert {r.doc_id for r in rows if r.text == "copy"} == {999} and {r.doc_id for r in rows if r.text == "a"} == {3}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


def test_texts_are_compared_in_salted_groups(docs):
    plan = exact_dedup.combine(exact_dedup._rows(docs, exact_dedup.sha256))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(salt" in plan and "Python" not in plan and "Arrow" not in plan
