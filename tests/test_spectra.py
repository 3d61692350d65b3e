import math
import random

import numpy as np
import pytest

from runlens.operators import spectra as s
from runlens.plans.tables import write_table

SPECTRA = ("run_id string, spectrum_id bigint, scan_no bigint, ms_level int, rt double,"
           " precursors array<struct<charge:int,mz:double>>")
SUMMARY = "run_id string, scan_no bigint, ms_level int, rt double, tic double, base_peak double, n_peaks bigint"


@pytest.fixture
def small(spark):
    spectra = [
        ("a", 1, 1, 1, 0.0, []),
        ("a", 2, 2, 2, 10.0, [(0, 500.0)]),
        ("a", 3, 3, 2, 20.0, [(-1, 501.0)]),
        ("a", 4, 4, 2, 30.0, [(9, 502.0), (2, 503.0)]),
        ("a", 5, 5, 2, 40.0, [(2, 504.0)]),
        ("a", 6, 6, 2, 45.0, []),
        ("a", 7, 7, 3, 5.0, [(2, 1.0)]),
        ("b", 8, 1, 1, 60.0, []),
    ]
    peaks = [(1, 100.0, 5.0), (1, 101.0, 7.0), (2, 200.0, 20.0), (7, 300.0, 50.0), (7, 301.0, 1.0)]
    return (spark.createDataFrame(spectra, SPECTRA),
            spark.createDataFrame(peaks, "spectrum_id bigint, mz double, intensity double"))


def test_summary_and_totals(small, rows):
    summary = s.spectrum_summary(*small)
    assert ("a", 4, 2, 30.0, 0.0, 0.0, 0) in rows(summary)
    assert ("a", 1, 1, 0.0, 12.0, 7.0, 2) in rows(summary)
    assert rows(s.accumulated_tic(summary)) == [("a", 12.0, 20.0), ("b", 0.0, 0.0)]
    assert rows(s.spectrum_counts(small[0])) == [("a", 1, 5), ("b", 1, 0)]
    assert rows(s.rt_range(small[0])) == [("a", 0.0, 5.0), ("b", 60.0, 60.0)]
    assert rows(s.run_maxima(summary)) == [("a", 50.0, 51.0), ("b", 0.0, 0.0)]
    # exactly at the limit counts; not positive means the whole run
    assert rows(s.run_maxima_up_to(summary, 10 / 60)) == [("a", 50.0, 51.0, 0.0, 10.0), ("b", None, None, 0.0, 10.0)]
    assert rows(s.run_maxima_up_to(summary, 0), "run_id", "tic_max") == [("a", 51.0), ("b", 0.0)]
    assert rows(s.tic_series(summary, [1])) == [("a", 1, 1, 0.0, 12.0), ("b", 1, 1, 60.0, 0.0)]


def test_nested_peaks_give_the_same_summary(spark, small, rows):
    spectra, peaks = small
    lists = {}
    for sid, mz, intensity in map(tuple, peaks.collect()):
        lists.setdefault(sid, []).append((mz, intensity))
    nested = spark.createDataFrame(
        [(*tuple(r)[:1], r["scan_no"], r["ms_level"], r["rt"], lists.get(r["spectrum_id"], [])) for r in spectra.collect()],
        "run_id string, scan_no bigint, ms_level int, rt double, peaks array<struct<mz:double,intensity:double>>")
    assert rows(s.spectrum_summary_nested(nested)) == rows(s.spectrum_summary(spectra, peaks))


def test_precursor_rules(small, rows):
    got = {(r, c): f for r, c, f in rows(s.precursor_charge_fractions(small[0], 3))}
    # 5 MS2 spectra: unknown 1, negative and none in no bucket, 9 as "more", one of charge 2
    assert [got["a", c] for c in range(5)] == [0.2, 0.0, 0.2, 0.0, 0.2]
    assert all(got["b", c] is None for c in range(5))
    assert rows(s.precursor_violations(small[0])) == [("a", 4, 2), ("a", 6, 0)]
    assert ("a", 2, 10.0, 1, True, 500.0) in rows(s.precursor_mz(small[0]))


@pytest.mark.parametrize("threshold, kept", [(0.0, 2), (0.1, 2), (0.12, 1), (0.141, 0)])
def test_ion_map_threshold_is_of_the_whole_run(small, rows, join_way, threshold, kept):
    # the highest intensity (50) is in an MS3 spectrum; 0.1 puts the limit exactly on a peak
    assert len(rows(s.ion_map(*small, threshold))) == kept


def brute_tic_fractions(points, first, last):
    """Definition on sorted lists: (rt, level, scan, tic)."""
    points = sorted(points, key=lambda p: p[:3])
    rt, tic = [p[0] for p in points], [p[3] for p in points]
    cum = np.cumsum(tic)[:-1]
    if len(cum) == 0 or cum[-1] == 0:
        return None
    i25, i50, i75 = (int(np.argmax(cum / cum[-1] >= p)) for p in (0.25, 0.5, 0.75))
    d = last - first
    at = lambda i: rt[max(i - 1, 0)]
    return [(at(i25) - rt[0]) / d, (at(i50) - rt[i25]) / d, (at(i75) - rt[i50]) / d, (rt[-1] - rt[i75]) / d]


def random_summary(seed, n=4000):
    random.seed(seed)
    data = []
    for scan in range(n):
        run = "hot" if random.random() < 0.7 else random.choice(["u", "v", "w"])
        rt = float(random.randrange(0, 900)) if run != "v" else random.random() * 300
        tic = float(random.randrange(0, 100)) if run != "w" else float(random.choice([0, 0, 1]))
        data.append((run, scan, random.choice([1, 2, 3]), rt, tic, tic, random.randrange(0, 40)))
    data.append(("one", 0, 1, 5.0, 3.0, 3.0, 2))
    data += [("first", i, 1, float(i), t, t, 1) for i, t in enumerate([90.0, 5.0, 5.0, 1.0])]
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_brute_force(spark, seed):
    data = random_summary(seed)
    df = spark.createDataFrame(data, SUMMARY).repartition(5)
    runs = sorted({d[0] for d in data})
    fractions = {r["run_id"]: [r["q1"], r["q2"], r["q3"], r["q4"]] for r in s.tic_quantile_fractions(df).collect()}
    frequency = {(r["run_id"], r["ms_level"]): r["freq_max"] for r in s.max_frequency(df).collect()}
    changes = {r["run_id"]: [r["q2"], r["q3"], r["q4"]] for r in s.tic_change_ratios(df).collect()}
    ratios = {r["run_id"]: [r["q2"], r["q3"], r["q4"]] for r in s.tic_quantile_ratios(df).collect()}
    density = {(r["run_id"], r["ms_level"]): [r["q25"], r["q50"], r["q75"]] for r in s.density_quantiles(df).collect()}
    spans = {r["run_id"]: [r["q1"], r["q2"], r["q3"], r["q4"]]
             for r in s.rt_quantile_fractions(df).where("ms_level = 2").collect()}

    def log_ratios(values):
        a, b, c = np.quantile(values, [.25, .5, .75])
        pairs = ((b, a), (c, b), (max(values), c))
        return [math.log2(x / y) if y > 0 and x > 0 else None for x, y in pairs]

    for run in runs:
        mine = sorted((d for d in data if d[0] == run), key=lambda d: d[1])
        first, last = mine[0][3], mine[-1][3]
        expected = brute_tic_fractions([(d[3], d[2], d[1], d[4]) for d in mine if d[2] < 3], first, last)
        if expected is None:
            assert fractions[run] == [None] * 4
        else:
            assert fractions[run] == pytest.approx(expected)
        for level in (1, 2):
            rts = np.array([d[3] for d in mine if d[2] == level])
            if len(rts) == 0:
                assert (run, level) not in frequency
                continue
            best = max(((rts >= t) & (rts <= t + 60)).sum() for t in rts)
            assert frequency[run, level] == best / 60
            peaks = np.quantile([d[6] for d in mine if d[2] == level], [.25, .5, .75])
            assert density[run, level] == [int(x) for x in peaks]
        ms1 = [d[4] for d in mine if d[2] == 1]
        assert ratios[run] == pytest.approx(log_ratios(ms1))
        if len(ms1) > 1:
            assert changes[run] == pytest.approx(log_ratios(list(np.abs(np.diff(ms1)))))
        else:
            assert run not in changes
        ms2 = [d[3] for d in mine if d[2] == 2]
        if ms2 and last != first:
            a, b, c = np.quantile(ms2, [.25, .5, .75])
            d = last - first
            assert spans[run] == pytest.approx([a / d, (b - a) / d, (c - b) / d, (d - c) / d])
        else:
            assert spans[run] == [None] * 4


def test_first_spectrum_may_hold_the_first_quarter(spark):
    df = spark.createDataFrame(random_summary(1), SUMMARY).where("run_id = 'first'")
    row = s.tic_quantile_fractions(df).first()
    # all thresholds are reached by the first spectrum: no span before it
    assert row["q1"] == 0 and row["q4"] == 1.0


def test_two_spectra_exactly_a_minute_apart(spark, rows):
    data = [("a", 1, 1, 3.5, 1.0, 1.0, 1), ("a", 2, 1, 63.5, 1.0, 1.0, 1), ("a", 3, 1, 63.6, 1.0, 1.0, 1)]
    assert rows(s.max_frequency(spark.createDataFrame(data, SUMMARY))) == [("a", 1, 2 / 60)]


def test_start_time(spark, rows):
    runs = spark.createDataFrame(
        [("a", "2024-02-29", "12:00:01"), ("b", None, "12:00:00"), ("c", "2024-13-01", "12:00:00"),
         ("d", "2024-01-01", None), ("e", "1970-01-01", "00:00:00")], "run_id string, date string, time string")
    assert rows(s.run_start_time(runs)) == [("a", 1709208001), ("b", -1), ("c", -1), ("d", -1), ("e", 0)]


def test_numbered_ion_map(spark, rows):
    random.seed(4)
    spectra = [(i, "hot" if i % 5 else "b", 1000 - i // 2, 1 if i % 3 else 2, float(i)) for i in range(200)]
    peaks = [(random.randrange(200), random.choice([1.0, 2.0, 3.5]), float(random.randrange(1, 9))) for _ in range(3000)]
    table = write_table(spark.createDataFrame(spectra, "spectrum_id bigint, run_id string, scan_no bigint, ms_level int, rt double"))
    p = write_table(spark.createDataFrame(peaks, "spectrum_id bigint, mz double, intensity double").repartition(7))
    at, want = {x[0]: x for x in spectra}, []
    for run in ("hot", "b"):
        top = max(i for k, _, i in peaks if at[k][1] == run)
        kept = sorted((at[k][2], k, m, i, at[k][4]) for k, m, i in peaks if at[k][1] == run and at[k][3] == 1 and i >= top * 0.6)
        want += [(run, n, scan, rt, m, i) for n, (scan, _, m, i, rt) in enumerate(kept)]
    assert rows(s.numbered_ion_map(table, p, 0.6)) == sorted(want)
    assert rows(s.ion_map(table, p, 0.6)) == sorted((r, scan, rt, m, i) for r, _, scan, rt, m, i in want)
