"""Hard negatives against brute force, and the bounds of the segment summaries."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runlens.llm import hard_negatives as hn

EXTRA = ["row_no", "anchor", "score", "share", "probe", "v", "x"]
SCHEMA = "vec_id bigint, embedding array<double>, label int"


def usable(row):
    _, v, label = row
    return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, step=50):
    seen = []
    for i, v, label in dict.fromkeys((i, None if v is None else tuple(v), label) for i, v, label in rows):
        if usable((i, v, label)):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            seen.append((i, [max(-2 ** 63, min(2 ** 63 - 1, math.floor(256 * x))) for x in v], label))
    key = lambda found: (-found[1], found[0] is None, found[0] or 0)
    out = []
    for i, v, label in seen:
        if i is None or i % step:
            continue
        scored = [((j, max(-hn.LARGEST, min(hn.LARGEST, sum(a * b for a, b in zip(v, w))))), m) for j, w, m in seen if (j, w, m) != (i, v, label)]
        positives = sorted((s for s, m in scored if m == label), key=key)[:5]
        for j, p in positives:
            negatives = sorted((s for s, m in scored if m != label and 50 * p <= 100 * s[1] <= 95 * p), key=key)[:3]
            out += [(i, j, k, n, p, s) for k, (n, s) in enumerate(negatives, 1)]
    return sorted(out, key=str)


def found(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hn.hard_negatives(df, F.col("vec_id") % 50 == 0, label).collect()
    return sorted((tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in rows), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in EXTRA})


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d)) / np.sqrt(d)
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, d)) * 0.5 / np.sqrt(d)
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, rng.integers(0, 10, n)))]


@pytest.mark.parametrize("block", [8, 8_192])
def test_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", block)
    rows = clustered(1500, 20, 1)
    want = brute(rows)
    assert len(want) > 200 and found(table(spark, rows)) == want


def test_odd_rows(spark):
    rows = clustered(300, 16, 2)
    rows += [(400, None, 1), (450, [1.0] * 16, None), (451, [None] + [1.0] * 15, 2), (500, [math.nan] * 16, 2), (550, [math.inf] * 16, 2),
             (600, [], 3), (601, [0.0] * 16, 3), (650, [2.0, 1.0], 4), (651, [2.0, 1.0, 3.0], 4), (700, [1.0] * 40, 5), (None, [1.0] * 16, 4)]
    rows += rows[:40] + [(1000 + k, [0.25] * 16, k % 2) for k in range(160)]
    want = brute(rows)
    assert {100, 1000, 650} <= {r[0] for r in want} and found(table(spark, rows)) == want


def test_products_beyond_doubles(spark):
    rng = np.random.default_rng(4)
    scale = [1.0, 1e7, 3e13, 1e300]
    rows = [(i, (rng.normal(size=8) * scale[i % 4]).tolist(), int(i % 3)) for i in range(200)]
    assert found(table(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(50, None, 1)])) == [] and found(table(spark, [(50, [1.0], 1)])) == []


def test_bounds_close_no_pair_within_the_limits():
    rng = np.random.default_rng(5)
    closed = 0
    for width in (5, 16, 64):
        x = np.floor(256 * (rng.normal(size=(300, width)) * 0.2 + rng.normal(size=(300, 1)))).astype(np.int64)
        part = pa.table({"v": pa.array(x.tolist(), pa.list_(pa.int64())), "row_no": np.arange(300), "label": np.zeros(300, np.int64),
                         "vec_id": np.arange(300)})
        rows = hn._Rows(part, width)
        exact = x @ x.T
        low, high = np.quantile(exact, 0.9, axis=1), np.quantile(exact, 0.95, axis=1)
        i, j = hn.open_pairs(rows, rows, np.ones((300, 300), bool), low, high, 0)
        inside = {(a, b) for a, b in zip(*np.nonzero((exact >= low[:, None]) & (exact <= high[:, None])))}
        assert inside <= set(zip(i.tolist(), j.tolist()))
        assert (hn.scores(rows, rows, i, j) == exact[i, j]).all()
        closed += 300 * 300 - len(i)
    assert closed > 100_000
