import random

import pytest
from pyspark.sql import functions as F

from runlens.functions.exprs import plain_sequence
from runlens.operators import targeted as t
from runlens.plans.tables import write_table

SPIKEINS = ("run_id string, name string, sequence string, mz double, rt double, mz_tol string,"
            " rt_tol double, position bigint")


@pytest.fixture
def spikeins(spark):
    return spark.createDataFrame([
        ("a", "one", "PEPTIDE", 500.0, 120.0, "10 ppm", 180.0, 1),
        ("a", "two", "EM[Oxidation]K", 600.0, 600.0, "20 ppm", 60.0, 2),
        ("a", "three", "EMK/2", 601.0, 660.0, "30 ppm", 60.0, 3),
        ("b", "one", "PEPTIDE", 500.0, 120.0, "10 ppm", 180.0, 1),
    ], SPIKEINS)


@pytest.mark.parametrize("text, plain", [
    ("PEPTIDE", "PEPTIDE"), ("EM[Oxidation]EVEES[UNIMOD:21]PEK", "EMEVEESPEK"),
    ("[Acetyl]-PEPK/2", "PEPK"), ("<[S-carboxamidomethyl-L-cysteine]@C>ATPEC", "ATPEC"),
    ("{Glycan:Hex}EMEK-[Amidated]", "EMEK"), ("EM[+15.9949]EK", "EMEK"), ("EM[info:x[y]z]EK", "EMEK"),
])
def test_plain_sequence(spark, text, plain):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(plain_sequence(F.col("s"))).first()[0] == plain


def test_query_windows(spikeins, rows):
    got = rows(t.xic_query_windows(spikeins), "run_id", "comment", "tolerance", "tolerance_unit", "rt_start", "rt_end")
    # the last of two targets with one plain sequence wins
    assert got == [("a", "one", 10.0, "ppm", -1.0, 5.0), ("a", "three", 30.0, "ppm", 10.0, 12.0),
                   ("b", "one", 10.0, "ppm", -1.0, 5.0)]
    assert t.xic_query_windows(spikeins, key="name").count() == 4


def test_matches_move_windows(spark, spikeins, rows, join_way):
    psms = spark.createDataFrame([
        ("a", "EMK", 300.0, 0.001), ("a", "EMK", 300.0, 0.001), ("a", "EMK", 360.0, 0.0099),
        ("a", "EMK", 900.0, 0.01), ("a", "OTHER", 1.0, 0.0), ("b", "EMK", 5.0, 0.0)],
        "run_id string, sequence string, retention_time double, score double")
    queries = t.xic_query_windows(spikeins)
    matches = t.match_target_psms(psms, queries)
    assert matches.count() == 3
    assert t.match_target_psms(psms, queries, None).count() == 4
    found = t.found_targets(matches)
    assert rows(t.ident_counts(found)) == [("a", "EMK", 2)]
    moved = {(r, c): (x, y) for r, c, x, y in
             rows(t.recenter_windows(queries, found), "run_id", "comment", "rt_start", "rt_end")}
    assert moved == {("a", "three"): (4.5, 6.5), ("a", "one"): (0.0, 5.0), ("b", "one"): (0.0, 5.0)}


@pytest.mark.parametrize("nested", [False, True])
@pytest.mark.parametrize("block", [3, 100_000])
def test_extract_xic_equals_brute_force(spark, join_way, block, nested, monkeypatch):
    monkeypatch.setattr(t, "WINDOW_ROWS", block)
    random.seed(11)
    spectra = [(i, random.choice("ab"), i, random.random() * 600) for i in range(300)]
    hot = [(random.randrange(300), 500.0 + random.random() * 0.02 - 0.01, float(random.randrange(9))) for _ in range(2000)]
    peaks = hot + [(random.randrange(300), random.random() * 1000, 1.0) for _ in range(2000)]
    queries = [("a", "q1", 500.0, 10.0, "ppm", 0.0, 5.0), ("a", "wide", 400.0, 5000.0, "ppm", 2.0, 4.0),
               ("b", "q1", 500.0, 3.0, "ppm", 1.0, 9.0), ("b", "none", 5000.0, 3.0, "ppm", 1.0, 9.0)]
    at_spectrum = spark.createDataFrame(spectra, "spectrum_id bigint, run_id string, scan_no bigint, rt double")
    of_peaks = spark.createDataFrame(peaks, "spectrum_id bigint, mz double, intensity double")
    if nested:
        arrays = of_peaks.groupBy("spectrum_id").agg(F.collect_list(F.struct("mz", "intensity")).alias("peaks"))
        at_spectrum, of_peaks = write_table(at_spectrum.join(arrays, "spectrum_id", "left")), None
    else:
        at_spectrum, of_peaks = write_table(at_spectrum), write_table(of_peaks)
    got = t.extract_xic(at_spectrum, of_peaks, spark.createDataFrame(
        queries, "run_id string, comment string, mz double, tolerance double, tolerance_unit string, rt_start double, rt_end double"))
    expected = []
    at = {s[0]: s for s in spectra}
    for run, comment, mz, tol, _, lo, hi in queries:
        delta = mz / 1000000 * tol
        for sid, m, intensity in peaks:
            _, r, scan, rt = at[sid]
            if r == run and mz - delta <= m < mz + delta and lo * 60 <= rt < hi * 60:
                expected.append((run, comment, scan, rt / 60, m, intensity))
    assert len(expected) > 100
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    # The peaks move to their spectrum, or not at all, and never to the windows.
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert not any("cell" in line or "run_id" in line for line in moved) and (not nested or not moved)


def test_unit_other_than_ppm_is_an_error(spark):
    query = spark.createDataFrame([("a", "q", 1.0, 1.0, "Da", 0.0, 1.0)],
                                  "run_id string, comment string, mz double, tolerance double,"
                                  " tolerance_unit string, rt_start double, rt_end double")
    with pytest.raises(Exception, match="unsupported tolerance unit of q"):
        t.mz_windows(query).collect()


def test_apex_takes_the_first_maximum(spark, rows):
    points = spark.createDataFrame(
        [("a", "q", 3, 0.3, 1.0, 9.0), ("a", "q", 2, 0.2, 1.0, 9.0), ("a", "q", 1, 0.1, 1.0, 1.0)],
        "run_id string, comment string, scan_no bigint, rt double, mz double, intensity double")
    assert rows(t.xic_apex(points)) == [("a", "q", 9.0, 12.0)]
    xics = spark.createDataFrame([
        ("a", "tie", 0, [0.5, 1.0, 1.5], [1.0, 7.0, 7.0]), ("a", "empty", 1, [], []), ("a", "null", 2, None, None),
        ("a", "twice", 3, [1.0], [5.0]), ("a", "twice", 4, [2.0], [4.0])],
        "run_id string, comment string, position int, retention_times array<double>, intensities array<double>")
    assert rows(t.xic_apex_of_arrays(xics)) == [
        ("a", "empty", 0.0, -1.0), ("a", "null", 0.0, -1.0), ("a", "tie", 7.0, 60.0), ("a", "twice", 4.0, 120.0)]


def test_spikein_metrics(spark, spikeins, rows):
    apexes = spark.createDataFrame([("a", "one", 9.0, 130.0), ("a", "unknown", 1.0, 1.0)],
                                   "run_id string, comment string, maximum_intensity double, rt_at_maximum double")
    counts = spark.createDataFrame([("a", "EMK", 3)], "run_id string, sequence string, count bigint")
    got = rows(t.spikein_metrics(spikeins, apexes, counts), "run_id", "name", "maximum_intensity",
               "rt_at_maximum", "nr_identifications", "delta_to_expected_rt")
    assert got == [("a", "one", 9.0, 130.0, 0, 10.0), ("a", "three", 0.0, -1.0, 3, -661.0),
                   ("a", "two", 0.0, -1.0, 3, -601.0), ("b", "one", 0.0, -1.0, 0, -121.0)]
