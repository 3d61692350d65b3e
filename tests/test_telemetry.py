import itertools
import random
import struct

import pytest

from runlens.operators import telemetry as t
from runlens.operators.crossrun import headers_long
from runlens.plans.tables import write_table


def test_select_headers(spark, rows):
    headers = spark.createDataFrame(
        [("a", "LM Correction now"), ("a", "LM m/z-Correction (ppm):"), ("a", "Other"), ("a", "LM Correction now")],
        "run_id string, header string")
    assert rows(t.select_headers(headers, ["LM m/z-Correction (ppm),LM Correction", "LM C"])) == [
        ("a", "LM Correction now", "LM C"),
        ("a", "LM Correction now", "LM m/z-Correction (ppm),LM Correction"),
        ("a", "LM m/z-Correction (ppm):", "LM m/z-Correction (ppm),LM Correction")]


def test_scan_headers(spark, rows):
    scans = spark.createDataFrame([("a", 1, 0.5, 1), ("a", 2, 1.0, 2), ("a", 3, 9.0, 1), ("b", 1, 9.0, 1)],
                                  "run_id string, scan_no bigint, rt double, ms_level int")
    trailer = spark.createDataFrame([("a", 1, "Ion Injection Time (ms):", 5.0), ("a", 2, "Ion Injection Time (ms):", 6.0),
                                     ("a", 1, "Unwanted", 0.0), ("a", 1, "Lock Mass #1 (m/z):", 7.0)],
                                    "run_id string, scan_no bigint, header string, value double")
    log = spark.createDataFrame([("a", 1.0, "CPU core temp. (°C)", 40.0), ("a", 1.0, "Unwanted", 1.0),
                                 ("a", 2.0, "CPU core temp. (°C)", 41.0)],
                                "run_id string, rt double, header string, value double")
    got = write_table(t.scan_header_table(scans, trailer, log))
    assert rows(got, "run_id", "scan_no", "name", "value") == [
        ("a", 1, "EXTRA_Ion Injection Time (ms)", 5.0), ("a", 1, "EXTRA_Lock Mass #1 (mz)", 7.0),
        ("a", 2, "EXTRA_Ion Injection Time (ms)", 6.0),
        # a record logged at the scan's own time is in force; none before the first
        ("a", 2, "LOG_CPU core temp. (°C)", 40.0), ("a", 3, "LOG_CPU core temp. (°C)", 41.0),
        # a scan without any value stays
        ("b", 1, None, None)]
    wide = t.wide_headers(got)
    assert rows(wide, "run_id", "scan_no", "`LOG_CPU core temp. (°C)`") == [
        ("a", 1, None), ("a", 2, 40.0), ("a", 3, 41.0), ("b", 1, None)]
    wide = wide.withColumnsRenamed({"rt": "Scan_StartTime", "ms_level": "Scan_msLevel"}).drop("scan_no")
    assert rows(headers_long(wide)) == [
        ("a", "EXTRA_Ion Injection Time (ms) (MS1 filtered)", 0.5, 5.0), ("a", "EXTRA_Lock Mass #1 (mz)", 0.5, 7.0),
        ("a", "LOG_CPU core temp. (°C)", 1.0, 40.0), ("a", "LOG_CPU core temp. (°C)", 9.0, 41.0)]
    with pytest.raises(ValueError, match="no time column"):
        headers_long(wide.drop("Scan_StartTime"))


def test_header_values_last_until_logged_again(spark, rows, join_way):
    """Records hold unlike headers, two labels belong to one entry, one label to two."""
    scans = spark.createDataFrame([("a", i, float(i), 1) for i in range(6)] + [("b", 0, 5.0, 1)],
                                  "run_id string, scan_no bigint, rt double, ms_level int")
    trailer = spark.createDataFrame([], "run_id string, scan_no bigint, header string, value double")
    log = spark.createDataFrame([
        ("a", 1.0, "T left", 10.0), ("a", 1.0, "U", 1.0), ("a", 2.5, "T right", 20.0), ("a", 3.0, "T left", None), ("a", 3.0, "U", 3.0),
        ("a", 4.0, "T left", 11.0), ("a", 4.0, "T left", 9.0), ("a", 0.0, "unwanted", 0.0)],
        "run_id string, rt double, header string, value double")
    wide = t.wide_headers(write_table(t.scan_header_table(scans, trailer, log, [], ["T", "U,T right"])))
    assert wide.columns[4:] == ["LOG_T [T left]", "LOG_T [T right]", "LOG_U,T right [T right]", "LOG_U,T right [U]"]
    assert rows(wide.drop("rt", "ms_level")) == [
        ("a", 0, None, None, None, None), ("a", 1, 10.0, None, None, 1.0), ("a", 2, 10.0, None, None, 1.0),
        ("a", 3, 10.0, 20.0, 20.0, 3.0), ("a", 4, 11.0, 20.0, 20.0, 3.0), ("a", 5, 11.0, 20.0, 20.0, 3.0),
        ("b", 0, None, None, None, None)]


def test_repeated_header_of_a_scan_is_an_error(spark):
    scans = spark.createDataFrame([("a", 1, 0.5, 1)], "run_id string, scan_no bigint, rt double, ms_level int")
    trailer = spark.createDataFrame([("a", 1, "X", 5.0), ("a", 1, "X", 6.0)], "run_id string, scan_no bigint, header string, value double")
    log = spark.createDataFrame([], "run_id string, rt double, header string, value double")
    long = t.scan_header_table(scans, trailer, log, ["X"], [])
    assert long.count() == 2
    with pytest.raises(Exception, match="more than one value"):
        t.wide_headers(long).collect()


def test_tune_values(spark, rows):
    tune = spark.createDataFrame([("a", "Vaporizer Temp. (-):", 3.0), ("a", "x", 1.0)],
                                 "run_id string, header string, value double")
    assert rows(t.tune_values(tune), "run_id", "name", "value") == [("a", "TUNE_Vaporizer Temp. (-)", 3.0)]


def test_pump_pressure(spark, rows, join_way):
    traces = spark.createDataFrame(
        [("a", 1, "Pump_Pressure bar", 0.0, 1.0), ("a", 2, "NC_Pump_Pressure bar", 0.0, 2.0),
         ("a", 2, "NC_Pump_Pressure bar", 1.0, 3.0), ("b", 1, "other", 0.0, 4.0)],
        "run_id string, trace_id int, label string, x double, y double")
    runs = spark.createDataFrame([("a",), ("b",), ("c",)], "run_id string")
    missing = [("b", None, None), ("c", None, None)]
    assert rows(t.pump_pressure(traces, runs)) == [("a", 0.0, 2.0), ("a", 1.0, 3.0)] + missing
    assert rows(t.pump_pressure(traces, runs, keep="first")) == [("a", 0.0, 1.0)] + missing


def test_decode_packed_trace(spark, rows):
    big = 2 ** 63 + 4096
    chunks = spark.createDataFrame([
        ("a", 1, bytearray(struct.pack("<QQ", 1, big)), bytearray(struct.pack("<II", 7, 2 ** 32 - 1))),
        ("a", 2, bytearray(struct.pack("<Q", 9) + b"\x01\x02"), bytearray(b"\x05")),
        ("b", 1, bytearray(b""), bytearray(b"")), ("c", 1, None, None),
    ], "run_id string, chunk_no int, times binary, intensities binary")
    assert rows(t.decode_packed_trace(chunks, ["run_id"])) == [
        ("a", 0, 1.0, 7.0), ("a", 1, float(big), float(2 ** 32 - 1)), ("a", 2, 9.0, 5.0), ("a", 3, 513.0, None)]


def _packed(numbers, width):
    return bytearray(b"".join(int(x).to_bytes(width, "little") for x in numbers))


@pytest.mark.parametrize("cell", [3, 7, 16_384])
def test_trace_of_chunks_with_unlike_counts(spark, cell, monkeypatch):
    monkeypatch.setattr(t, "TRACE_CELL", cell)
    rng = random.Random(cell)
    rows, want = [], []
    for trace in range(6):
        times, values, n_chunks = [], [], rng.randint(1, 9)
        for chunk in range(n_chunks):
            n = rng.randint(0, 12)
            # Some chunks pair up by themselves, some only behind earlier ones, some never.
            m = n if rng.random() < 0.5 else rng.randint(0, 12)
            ts, vs = [rng.getrandbits(64) for _ in range(n)], [rng.getrandbits(32) for _ in range(m)]
            tail = rng.random() < 0.3 and n
            if tail:
                ts[-1] = rng.getrandbits(24)
            packed = _packed(ts, 8)
            rows.append(("r", trace, chunk, packed[:-5] if tail else packed, _packed(vs, 4) if vs or chunk % 2 else None))
            times, values = times + ts, values + vs
        want += [(trace, i, float(x) if x is not None else None, float(y) if y is not None else None)
                 for i, (x, y) in enumerate(itertools.zip_longest(times, values))]
    rng.shuffle(rows)
    chunks = spark.createDataFrame(rows, "run_id string, trace_id int, chunk_no int, times binary, intensities binary").repartition(5)
    got = t.decode_packed_trace(chunks, ["run_id", "trace_id"]).collect()
    assert sorted((r.trace_id, r.pos, r.time, r.value) for r in got) == sorted(want)


def test_packed_pump_pressure(spark, rows, join_way):
    sources = spark.createDataFrame([
        ("a", 3, "NC_Pump_Pressure"), ("a", 2, "Oven"), ("a", 5, "NC_Pump_Pressure"), ("b", 1, "Oven"), ("d", 1, "NC_Pump_Pressure")],
        "run_id string, id int, description string")
    chunks = spark.createDataFrame([
        ("a", 3, 1, _packed([4], 8), _packed([40, 50], 4)), ("a", 3, 0, _packed([1, 2, 3], 8), _packed([10], 4)),
        ("a", 5, 0, _packed([9], 8), _packed([90], 4)), ("a", 2, 0, _packed([7], 8), _packed([70], 4)),
        ("b", 1, 0, _packed([8], 8), _packed([80], 4))],
        "run_id string, trace_id int, chunk_no int, times binary, intensities binary")
    runs = spark.createDataFrame([(x,) for x in "abcd"], "run_id string")
    missing = [(x, None, None, None) for x in "bcd"]
    points = [("a", 0, 1.0, 10.0), ("a", 1, 2.0, 40.0), ("a", 2, 3.0, 50.0), ("a", 3, 4.0, None)]
    assert rows(t.packed_pump_pressure(sources, chunks, runs)) == points + missing
    assert rows(t.packed_pump_pressure(sources, chunks, runs, keep="last")) == [("a", 0, 9.0, 90.0)] + missing


def test_properties_and_frames(spark, rows, join_way):
    properties = spark.createDataFrame(
        [("a", 1, 10, 5.0), ("a", 2, 10, None), ("a", 1, 11, 6.0), ("a", 1, 12, 9.0)],
        "run_id string, frame bigint, property_id int, value double")
    definitions = spark.createDataFrame([("a", 10, "T1"), ("a", 11, "T2"), ("a", 12, "unwanted")],
                                        "run_id string, id int, name string")
    wide = t.pivot_properties(properties, definitions, ["T1", "T2", "T3"])
    assert rows(wide) == [("a", 1, 5.0, 6.0, None), ("a", 2, None, None, None)]
    frames = spark.createDataFrame([("a", 1, 0.1, 0, 2.5), ("a", 3, 0.3, 9, 2.6)],
                                   "run_id string, id bigint, time double, msms_type int, Pressure double")
    table = t.frame_table(frames, wide, ["Pressure", "NotThere"])
    assert table.columns == ["run_id", "id", "time", "msms_type", "Pressure", "T1", "T2", "T3"]
    assert rows(table) == [("a", 1, 0.1, 0, 2.5, 5.0, 6.0, None), ("a", 3, 0.3, 9, 2.6, None, None, None)]


def test_calibrants(spark, rows):
    peaks = spark.createDataFrame([
        ("a", 1.0, 1.0, 0, 90.0, 5.0, 1), ("a", 1.0, 1.0, 0, 109.9, 5.0, 2), ("a", 1.0, 1.0, 0, 110.0, 99.0, 3),
        ("a", 1.0, 1.0, 1, 100.0, 99.0, 4), ("a", 1.0, 1.2, 0, 100.0, 99.0, 5), ("a", 2.0, 0.95, 0, 101.0, 1.0, 6)],
        "run_id string, rt double, mobility double, precursor_idx int, mz double, intensity double, position bigint")
    got = t.track_calibrants(peaks, ["100:1.0", "700:1.0"])
    assert rows(got, "calibrant_no", "observed_rt", "observed_mz", "observed_mobility") == [
        (1, 1.0, 90.0, 1.0), (1, 2.0, 101.0, 0.95)]
    with pytest.raises(ValueError, match="MZ:Mobility"):
        t.parse_calibrants(["100;1"])
    assert t.parse_calibrants(t.CALIBRANTS)[1] == (922.009798, 1.1895)


def test_unpacking_holds_little_beside_the_result():
    import tracemalloc

    import pyarrow as pa
    from runlens.functions.exprs import unpack_le
    data = [bytes(range(256)) * 4096 + b"\x01\x02\x03", None, b"", b"\xff" * 8]
    values = pa.array([b"left out", *data], pa.binary()).slice(1)
    for width in (4, 8):
        tracemalloc.start()
        got = unpack_le(values, width)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        whole = [[float(int.from_bytes(d[i:i + width], "little")) for i in range(0, len(d), width)] if d is not None else None for d in data]
        assert got.to_pylist() == whole
        # The result takes 8 / width bytes for each byte read.
        assert peak < (8 / width + 1) * len(data[0])
