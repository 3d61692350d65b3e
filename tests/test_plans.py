import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.plans import quantiles, tables
from runlens.plans.ordered import asof_backward, with_position
from runlens.plans.quantiles import exact_quantiles, ordered_bits
from runlens.plans.tables import attach, fits_broadcast, write_measured, write_table


def test_exact_quantiles_equal_numpy(spark, join_way):
    random.seed(7)
    groups = {
        "hot": [random.lognormvariate(0, 2) for _ in range(30_000)],
        "ties": [float(random.choice([1, 1, 1, 1, 2, 9])) for _ in range(5_000)],
        "one": [3.5], "two": [1.0, 2.0], "ten": [float(i * i) for i in range(10)],
        "same": [4.0] * 700, "zeros": [0.0, -0.0, 0.0], "signs": [random.gauss(0, 1) for _ in range(2_000)],
        "wide": [random.choice([-1, 1]) * 10.0 ** random.uniform(-320, 307) for _ in range(3_000)],
        "close": [1.0 + k * 2.0 ** -52 for k in range(4_000)], "half alike": [7.25] * 900 + [random.random() for _ in range(100)],
    }
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), ("hot", None)]
    random.shuffle(data)
    df = write_table(spark.createDataFrame(data, "run_id string, x double"))
    got = {r["run_id"]: r for r in exact_quantiles(df, ["run_id"], "x").collect()}
    assert set(got) == set(groups)
    for name, values in groups.items():
        assert got[name]["n"] == len(values)
        assert (got[name]["min"], got[name]["max"]) == (min(values), max(values))
        expected = np.quantile(values, [0.25, 0.5, 0.75])
        assert [got[name][q] for q in ("q25", "q50", "q75")] == pytest.approx(expected, rel=1e-12, abs=1e-300)


def test_exact_quantiles_of_other_shares_and_infinite_values(spark):
    values = [float((i * 7919) % 10_007) for i in range(10_007)]
    rows = [("a", 1, v) for v in values] + [("a", 2, v) for v in (float("inf"), float("-inf"), 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "run_id string, level int, x double")
    got = {r["level"]: r for r in exact_quantiles(df, ["run_id", "level"], "x", {"q10": 0.1, "q99": 0.99, "q00": 0, "q50": 0.5}).collect()}
    assert [got[1][q] for q in ("q10", "q99", "q00")] == pytest.approx(np.quantile(values, [0.1, 0.99, 0]))
    assert got[2]["q50"] == 2.0
    assert exact_quantiles(df.limit(0), ["run_id"], "x").count() == 0


def test_ordered_bits_are_those_of_the_double(spark):
    rng = np.random.default_rng(1)
    bits = np.concatenate([rng.integers(0, 2047 << 52, 20_000), np.arange(0, 200), (np.arange(1, 2047) << 52), (np.arange(1, 2047) << 52) - 1,
                           (np.arange(1, 2047) << 52) + 1, [2047 << 52]])
    values = bits.view(np.float64)
    df = spark.createDataFrame([(v,) for v in np.concatenate([values, -values]).tolist()], "v double").select("v", ordered_bits(F.col("v")).alias("b"))
    for v, b in df.collect():
        assert b == int(np.float64(abs(v)).view(np.int64)) * (-1 if v < 0 else 1)


def test_no_row_of_a_long_group_is_sorted(spark, monkeypatch):
    """Windows see counts only: at most one row for each digit of a position."""
    df = write_table(spark.range(60_000).select(F.lit("hot").alias("run_id"), F.sin("id").alias("x")))
    seen = []
    select = quantiles._select

    def counted(rows, *rest):
        seen.append(rows.groupBy("parent", "digit").count().count())
        return select(rows, *rest)
    monkeypatch.setattr(quantiles, "_select", counted)
    row = exact_quantiles(df, ["run_id"], "x").first()
    assert [row[q] for q in ("q25", "q50", "q75")] == pytest.approx(np.quantile(np.sin(np.arange(60_000)), [0.25, 0.5, 0.75]))
    assert len(seen) > 1 and all(n <= 6 * (2 ** quantiles.DIGIT_BITS + 1) for n in seen)


def test_broadcast_needs_few_rows_and_few_bytes(spark, monkeypatch):
    table = write_table(spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text")))
    assert fits_broadcast(table) and not fits_broadcast(table, rows_per_row=100_000)
    assert write_measured(table)[1] and not write_measured(table, rows_per_row=100_000)[1]
    monkeypatch.setattr(tables, "BROADCAST_BYTES", 5_000)
    assert not fits_broadcast(table) and fits_broadcast(table.select("id"))
    assert not write_measured(table)[1] and write_measured(table.select("id"))[1]


def test_with_position_counts_through_slices(spark):
    data = [("a", float(i), i) for i in range(5000)] + [("b", 1.0, i) for i in range(30)] + [("c", 0.0, 0)]
    random.seed(3)
    random.shuffle(data)
    df = spark.createDataFrame(data, "run_id string, t double, i int").repartition(7)
    got = {(r["run_id"], r["i"]): (r["pos"], r["n"]) for r in with_position(df, ["run_id"], ["t", "i"]).collect()}
    for run, n in (("a", 5000), ("b", 30), ("c", 1)):
        assert all(got[run, i] == (i, n) for i in range(n))


def test_asof_backward_equals_brute_force(spark):
    random.seed(5)
    left = [("hot" if random.random() < .8 else random.choice("xyz"), random.randrange(400) / 4, i)
            for i in range(4000)]
    right = [("hot" if random.random() < .8 else "x", random.randrange(400) / 4, 10_000 + i, random.random())
             for i in range(300)] + [("y", 50.0, 99_999, None)]
    got = asof_backward(
        spark.createDataFrame(left, "run_id string, t double, id int"),
        spark.createDataFrame(right, "run_id string, t double, id int, v double"),
        ["run_id"], "t", "id", ["v"])
    found = {r["id"]: r["v"] for r in got.collect()}
    assert len(found) == len(left)
    for run, t, i in left:
        before = [(x[1], x[2], x[3]) for x in right if x[0] == run and x[1] <= t]
        assert found[i] == (max(before, key=lambda x: x[:2])[2] if before else None)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_attach_keeps_every_row(spark, join_way, how):
    big = spark.createDataFrame([("a" if i % 3 else f"k{i}", i) for i in range(300)], "k string, i int")
    small = spark.createDataFrame([("a", 1.0), ("k0", 2.0), ("unused", 3.0)], "k string, w double")
    got = attach(big, small, ["k"], how)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        map(tuple, big.join(small, "k", how).collect()), key=str)


def test_shared_folder_is_read_from_the_session(spark, tmp_path, monkeypatch):
    from runlens.plans import tables
    monkeypatch.setattr(tables, "shared_dir", lambda s: str(tmp_path))
    assert write_table(spark.range(3), "t").agg(F.sum("id")).first()[0] == 3
    assert any(p.name.startswith("t-") for p in tmp_path.iterdir())


def test_written_table_leaves_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = files.getAllFiles().size()
    table = tables.write_table(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    deadline = time.time() + 20
    while files.getAllFiles().size() > before and time.time() < deadline:
        time.sleep(0.1)
    assert files.getAllFiles().size() <= before and table.count() == 7
    assert spark.conf.get(tables.SHUFFLES_GO) == "false"
