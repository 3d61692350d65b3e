import datetime
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.operators import crossrun as c
from runlens.operators import records as r
from runlens.operators import reports
from runlens.schemas import METRICS, Metric
from runlens.sources import sinks


@pytest.fixture
def metrics(spark):
    values = spark.createDataFrame(
        [("a", 10, [1.0, 61.0], 1709208001.0, 3.5), ("b", 20, [2.0, 62.0], -1.0, None)],
        "run_id string, n int, span array<double>, start double, top double")
    first = r.metric_records(values, {"n": "nr_MS1", "span": "RT_range", "start": "startTime"})
    only_a = r.metric_records(values.where("run_id = 'a'"), {"top": "total_ion_current_max"})
    return first.unionByName(only_a)


@pytest.fixture
def tables(spark):
    charges = spark.createDataFrame([("a", 0, .25), ("a", 1, .75), ("b", 0, 1.0), ("b", 1, 0.0)],
                                    "run_id string, charge int, fraction double")
    return r.metric_table(charges, "MS2_prec_charge_fraction", [
        r.TableColumn("charge", "MS:1000041", "charge state"), r.TableColumn("fraction", "UO:0000191", "fraction")],
        row_no="charge")


def test_metric_records_and_kinds(metrics, tables, rows):
    assert metrics.count() == 7
    row = metrics.where("run_id = 'a' AND short_name = 'RT_range'").first()
    assert (row["accession"], row["kind"], row["value_arr"], row["unit_name"]) == (
        "MS:4000070", "array", [1.0, 61.0], "second")
    assert rows(c.metric_kind(metrics, tables), "short_name", "kind") == [
        ("MS2_prec_charge_fraction", "table"), ("RT_range", "array"), ("nr_MS1", "scalar"),
        ("startTime", "scalar"), ("total_ion_current_max", "scalar")]


def test_metric_table_counts_rows_in_order(spark, rows):
    series = spark.createDataFrame([("a", 30, 3.0, "z"), ("a", 10, 1.0, "x"), ("b", 5, 9.0, "q")],
                                   "run_id string, scan_no int, tic double, label string")
    got = r.metric_table(series, "MS1_TIC", [r.TableColumn("tic", "X:1", "t"), r.TableColumn("label", "", "l")],
                         order=["scan_no"])
    assert rows(got, "run_id", "row_no", "column_no", "value_num", "value_str") == [
        ("a", 0, 0, 1.0, None), ("a", 0, 1, None, "x"), ("a", 1, 0, 3.0, None), ("a", 1, 1, None, "z"),
        ("b", 0, 0, 9.0, None), ("b", 0, 1, None, "q")]


def test_combining(spark, metrics, tables, rows):
    twice = c.combine_runs([metrics, metrics])  # builds; reading it finds the error
    with pytest.raises(Exception, match="metric key occurs more than once"):
        twice.collect()
    assert sorted(map(str, c.combine_runs([metrics]).collect())) == sorted(map(str, metrics.collect()))
    assert rows(c.combine_runs([tables.where("run_id = 'a'"), tables.where("run_id = 'b'")])) == rows(tables)
    with pytest.raises(Exception, match="table cell occurs more than once"):
        c.combine_runs([tables, tables.where("row_no = 1 AND column_no = 0")]).collect()
    both = c.combine_runs([metrics, c.namespaced(metrics, F.concat(F.lit("/x/y."), "run_id"))], check=False)
    assert rows(both.select("run_id").distinct()) == [("a",), ("b",), ("y",)]
    assert rows(c.duplicate_keys(both), "run_id", "short_name") == [("y", "RT_range"), ("y", "nr_MS1"), ("y", "startTime")]
    meta = c.combined_metadata(spark).first()
    assert meta["mzQC_format_version"] == "1.2"
    assert datetime.date.fromisoformat(meta["creation_date"]) >= datetime.date(2024, 1, 1)


def test_inventory(spark, metrics, rows):
    assert rows(c.metric_catalogue(metrics), "key") == [
        ("LOCAL:startTime ! startTime",), ("MS:4000059 ! nr_MS1",), ("MS:4000070 ! RT_range",),
        ("MS:4000204 ! total_ion_current_max",)]
    runs = spark.createDataFrame([("a",), ("b",), ("c",)], "run_id string")
    assert rows(c.exclude_empty_runs(runs, metrics)) == [("a",), ("b",)]
    assert rows(c.empty_runs(runs, metrics)) == [("c",)]
    keys = spark.createDataFrame([("a", "THERMO", "Extracted_Headers"), ("b", "MS:1", "x")],
                                 "run_id string, accession string, short_name string")
    c.require_one_vendor(keys)
    other = spark.createDataFrame([("b", "BRUKER", "Extracted_Headers")], keys.schema)
    with pytest.raises(ValueError, match="two vendors"):
        c.require_one_vendor(keys.union(other))


def test_summary(spark, metrics, tables, rows):
    runs = spark.createDataFrame([("b",), ("a",), ("c",)], "run_id string")
    order = ["startTime", "RT_range", "nr_MS1", "MS2_prec_charge_fraction", "unknown"]
    got = c.summary_table(c.summary_cells(metrics, tables, unit="min"), runs, order)
    assert got.columns == ["run_id", "startTime", "RT_range_min", "RT_range_max", "nr_MS1",
                           "MS2_prec_charge_fraction_0", "MS2_prec_charge_fraction_1", "unknown"]
    assert [tuple(x) for x in got.collect()] == [
        ("a", datetime.datetime(2024, 2, 29, 12, 0, 1), 1 / 60, 61 / 60, 10.0, .25, .75, None),
        ("b", datetime.datetime(1969, 12, 31, 23, 59, 59), 2 / 60, 62 / 60, 20.0, 1.0, 0.0, None),
        ("c", None, None, None, None, None, None, None)]
    assert rows(c.tables_wide(tables, ["MS2_prec_charge_fraction"], ["MS2_prec_charge_fraction_1"])) == [
        ("a", .75), ("b", 0.0)]
    assert rows(c.scalars_wide(metrics, ["nr_MS1", "total_ion_current_max"])) == [("a", 10.0, 3.5), ("b", 20.0, None)]
    assert rows(c.arrays_wide(metrics, ["RT_range_max"])) == [("a", 61.0), ("b", 62.0)]
    # the default order names every metric, those without data as empty columns
    columns = c.summary_table(c.summary_cells(metrics, tables), runs).columns
    assert columns[1:4] == ["startTime", "RT_range_min", "RT_range_max"] and columns[-1] == "spike_in_metrics"
    with pytest.raises(Exception, match="more than one value"):
        c.summary_table(c.summary_cells(metrics.unionByName(metrics), tables), runs, order).collect()


def test_summary_columns_come_from_the_data(spark):
    """High charges, longer arrays, texts and spike-ins, unlike from run to run."""
    fractions = spark.createDataFrame([("a", k, k / 100) for k in range(13)] + [("b", 40, 1.0)], "run_id string, charge int, fraction double")
    spikeins = spark.createDataFrame(
        [("a", 0, "PEP", 5.0, 120.0, 2, 60.0), ("a", 1, "PEP", 6.0, 180.0, 1, 60.0), ("b", 1, "TIDE", 7.0, -1.0, 0, 30.0)],
        "run_id string, row_no int, sequence string, maximum_intensity double, rt_at_maximum double, nr_identifications bigint, expected_rt double")
    tables = r.metric_table(fractions, "features_charges", reports.CHARGE_COLUMNS, row_no="charge").unionByName(
        r.metric_table(spikeins, "spike_in_metrics", reports.SPIKEIN_COLUMNS, row_no="row_no"))
    values = spark.createDataFrame([("a", [float(i) for i in range(11)], "left"), ("b", [1.0, 2.0], None)], "run_id string, v array<double>, t string")
    metrics = r.metric_records(values, {"v": "RT_TIC_quantiles", "t": "side"}, {"RT_TIC_quantiles": METRICS["RT_TIC_quantiles"], "side": Metric("X:1", "side")})
    runs = values.select("run_id")
    got = c.summary_table(c.summary_cells(metrics, tables, "min"), runs, ["side", "RT_TIC_quantiles", "features_charges", "spike_in_metrics"])
    pep = ["proforma peptidoform sequence", "MS1 feature maximum intensity", "retention time", "count of identified spectra",
           "predicted retention time", "Delta_to_expected_RT"]
    assert got.columns == (["run_id", "side"] + [f"RT_TIC_quantiles_{i}" for i in range(1, 12)] + [f"features_charges_{i}" for i in range(13)]
                           + ["features_charges_40"] + [f"PEP_{x}" for x in pep] + [f"PEP #2_{x}" for x in pep] + [f"TIDE_{x}" for x in pep])
    a, b = got.collect()
    assert (a["side"], b["side"], a["RT_TIC_quantiles_11"], b["RT_TIC_quantiles_11"]) == ("left", None, 10.0, None)
    assert (a["features_charges_12"], b["features_charges_12"], b["features_charges_40"]) == (.12, None, 1.0)
    assert [a[f"PEP #2_{x}"] for x in pep] == ["PEP", 6.0, 3.0, 1.0, 1.0, 2.0] and a["TIDE_retention time"] is None
    assert [b[f"TIDE_{x}"] for x in pep] == ["TIDE", 7.0, -1 / 60, 0.0, 0.5, -31 / 60]
    names = spark.createDataFrame([(0, "first"), (1, "second")], "row_no int, name string")
    named = c.summary_table(c.summary_cells(metrics, tables, spikein_names=names), runs, ["spike_in_metrics"])
    assert named.columns[1:] == [f"{n}_{x}" for n in ("first", "second") for x in pep]
    assert [x["second_retention time"] for x in named.collect()] == [180.0, -1.0]


def test_spikeins_wide(spark, rows):
    spikeins = spark.createDataFrame([("a", "one", 5.0, 120.0), ("a", "two", 6.0, 60.0), ("b", "two", 1.0, 0.0)],
                                     "run_id string, name string, maximum_intensity double, rt_at_maximum double")
    got = c.spikeins_wide(spikeins, ["rt_at_maximum"], unit="min")
    assert got.columns == ["run_id", "one_rt_at_maximum", "two_rt_at_maximum"]
    assert rows(got) == [("a", 2.0, 1.0), ("b", None, 0.0)]
    assert rows(c.spikeins_wide(spikeins, ["rt_at_maximum"], labels=["two"])) == [("a", 60.0), ("b", 0.0)]
    with pytest.raises(Exception, match="more than one value"):
        c.spikeins_wide(spikeins.unionByName(spikeins), ["rt_at_maximum"]).collect()


def test_long_forms(spark, metrics, rows, join_way):
    wide = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None)], "run_id string, x double, y double")
    long = c.melt_metrics(wide, ["x", "y"])
    back = long.groupBy("run_id").pivot("variable", ["x", "y"]).agg(F.max("value"))
    assert rows(back) == rows(wide)
    assert rows(c.array_to_long(metrics, "RT_range", "Q")) == [
        ("a", "Q_1", 1.0), ("a", "Q_2", 61.0), ("b", "Q_1", 2.0), ("b", "Q_2", 62.0)]
    buckets = spark.createDataFrame([("a", 0, .5), ("a", 1, .25), ("a", 2, .25), ("b", 0, 0.0)],
                                    "run_id string, charge int, fraction double")
    assert rows(c.relabel_buckets(buckets, "charge"), "run_id", "charge") == [
        ("a", "1"), ("a", "Unknown"), ("a", "more"), ("b", "more")]
    assert rows(c.normalise_within_run(buckets, "fraction"), "run_id", "fraction")[-1] == ("b", None)
    groups = spark.createDataFrame([("a", "control")], "run_id string, group string")
    assert rows(c.assign_groups(wide, groups), "run_id", "group") == [("a", "control"), ("b", None)]
    with pytest.raises(ValueError):
        c.overlay_series(wide, "x", "hours")


@pytest.mark.parametrize("n, limit, kept", [(10, 10, list(range(10))), (25, 10, list(range(0, 25, 2))), (19, 10, list(range(19)))])
def test_downsample(spark, n, limit, kept):
    series = spark.createDataFrame([("a", float(i)) for i in range(n)] + [("b", 1.0)], "run_id string, x double").repartition(3)
    got = c.downsample_every_nth(series, ["x"], limit)
    assert sorted(x for run, x in map(tuple, got.collect()) if run == "a") == kept
    assert got.where("run_id = 'b'").count() == 1


def test_scale_timestamps(spark, rows):
    times = spark.createDataFrame([("a", 10.0), ("b", 30.0), ("c", 15.0)], "run_id string, start_time double")
    assert rows(c.scale_timestamps(times)) == [("a", 0.0), ("b", 100.0), ("c", 25.0)]
    assert rows(c.scale_timestamps(times.where("run_id = 'a'"))) == [("a", 1.0)]


def test_components_equal_svd(spark):
    random.seed(2)
    columns = ["x", "y", "z", "constant"]
    data = [(f"r{i:02}", random.gauss(0, 1), random.gauss(5, 2), None if i == 3 else random.random(), 4.0)
            for i in range(30)]
    data = [(r_, x, y + 3 * x, z, k) for r_, x, y, z, k in data]
    wide = spark.createDataFrame(data, "run_id string, x double, y double, z double, constant double")
    scaled = c.standardise_features(wide, columns)
    matrix = np.array([[0.0 if v is None else v for v in row[1:]] for row in data])
    sd = matrix.std(axis=0)
    z = (matrix - matrix.mean(axis=0)) / np.where(sd == 0, 1, sd)
    got = {(r_, v): x for r_, v, x in map(tuple, c.features_long(scaled, columns).collect())}
    for i, row in enumerate(data):
        assert [got[row[0], v] for v in columns] == pytest.approx(z[i])

    _, s, vt = np.linalg.svd(z, full_matrices=False)
    sign = np.array([1 if v[np.argmax(np.abs(v))] >= 0 else -1 for v in vt])
    vt = vt * sign[:, None]
    components = c.Components(scaled, columns)
    scores = {x["run_id"]: (x["pca1"], x["pca2"]) for x in c.pca_scores(components).collect()}
    expected = z @ vt[:2].T
    for i, row in enumerate(data):
        assert scores[row[0]] == pytest.approx(expected[i])
    shares = [x["ratio"] for x in c.pca_explained_variance(components).orderBy("component").collect()]
    assert shares == pytest.approx((s ** 2 / (s ** 2).sum())[:2])
    loadings = c.pca_loadings(components).collect()
    assert [x["length"] for x in loadings] == sorted((x["length"] for x in loadings), reverse=True)
    by_name = {x["variable"]: (x["PC1"], x["PC2"]) for x in loadings}
    for j, name in enumerate(columns):
        assert by_name[name] == pytest.approx(vt[:2, j], abs=1e-12)
    times = wide.select("run_id", F.lit(5.0).alias("start_time"))
    assert {x["t_scaled"] for x in c.pca_scores(components, times).collect()} == {1.0}


def document(tmp_path, run):
    (file,) = (tmp_path / "mzqc" / f"run_id={run}").glob("part-*")
    return json.loads(file.read_text())


def test_mzqc_documents(spark, metrics, tables, tmp_path):
    long = spark.createDataFrame([("a", i, float(i) / 2, f'n"{i}') for i in range(300)],
                                 "run_id string, i int, v double, t string")
    series = r.metric_table(long, "MS1_TIC", [r.TableColumn("v", "MS:1000285", "v"), r.TableColumn("t", "MS:7", "t")],
                            row_no="i")
    unnamed = r.metric_table(long, "MS2_TIC", [r.TableColumn("v", "MS:1000285", "v"), r.TableColumn("t", "", "t")],
                             row_no="i")
    local = r.metric_table(long, "MS1_map", [r.TableColumn("v", "MS:1", "v")], row_no="i")
    everything = tables.unionByName(series).unionByName(unnamed).unionByName(local)
    sinks.write_mzqc(metrics, everything, str(tmp_path / "mzqc"), "2024-05-05T10:00:00")
    doc = document(tmp_path, "a")["mzQC"]
    assert doc["version"] == "1.0.0" and doc["creationDate"] == "2024-05-05T10:00:00"
    assert doc["controlledVocabularies"][0]["version"] == "4.1.197" and doc["setQualities"] == []
    run = doc["runQualities"][0]
    source = run["metadata"]["inputFiles"][0]
    assert source["name"] == "a" and source["fileFormat"]["accession"] == "MS:1000563"
    assert source["fileProperties"] == [{"accession": "MS:1002435", "name": "data processing start time",
                                         "value": "2024-02-29 12:00:01"}]
    assert run["metadata"]["analysisSoftware"][0]["name"] == "Comet"
    found = {m["accession"]: m for m in run["qualityMetrics"]}
    assert set(found) == {"MS:4000059", "MS:4000070", "MS:4000204", "MS:4000063", "MS:4000211", "MS:4000212"}
    assert found["MS:4000059"]["value"] == 10
    assert found["MS:4000059"]["unit"] == {"unit_accession": "UO:0000189", "unit_name": "count unit"}
    assert found["MS:4000070"]["value"] == [1, 61] and found["MS:4000204"]["value"] == 3.5
    assert found["MS:4000063"]["value"] == {"MS:1000041": [0, 1], "UO:0000191": [.25, .75]}
    assert "unit" not in found["MS:4000063"]
    assert found["MS:4000211"]["value"]["MS:1000285"] == [i / 2 for i in range(300)]
    assert found["MS:4000211"]["value"]["MS:7"] == [f'n"{i}' for i in range(300)]
    assert found["MS:4000212"]["value"] is None
    other = document(tmp_path, "b")["mzQC"]["runQualities"][0]
    assert other["metadata"]["inputFiles"][0]["fileProperties"] == []
    assert len(other["qualityMetrics"]) == 3


def test_registry_is_complete():
    assert len({m.accession for m in METRICS.values()}) == len(METRICS)
    assert all(isinstance(m, Metric) and m.name for m in METRICS.values())


def test_reports_of_tables(spark, rows):
    from runlens.operators import reports
    spikeins = spark.createDataFrame([("a", "PEP", 5.0, 60.0, 2, 61.0, 7)],
                                     "run_id string, sequence string, maximum_intensity double, rt_at_maximum double,"
                                     " nr_identifications bigint, expected_rt double, position bigint")
    got = rows(reports.spikein_table(spikeins), "row_no", "column_no", "column_accession", "value_num", "value_str")
    assert got[0] == (0, 0, "MS:1003169", None, "PEP") and got[4] == (0, 4, "MS:1000897", 61.0, None)
    wide = spark.createDataFrame([("a", 2.0, 7.0), ("a", 1.0, 6.0)], "run_id string, Time double, Pressure double")
    table = reports.header_table(wide, "bruker", ["Time"])
    assert rows(table, "accession", "row_no", "column_name", "value_num") == [
        ("BRUKER", 0, "Pressure", 6.0), ("BRUKER", 0, "Time", 1.0), ("BRUKER", 1, "Pressure", 7.0), ("BRUKER", 1, "Time", 2.0)]
    observed = spark.createDataFrame([("a", 1, 50.0, 0.5, 3.0, 49.0, 0.4)],
                                     "run_id string, calibrant_no int, calibrant_mz double, calibrant_mobility double,"
                                     " observed_rt double, observed_mz double, observed_mobility double")
    assert reports.calibrant_table(observed).count() == 5
    pressure = spark.createDataFrame([("a", None, None)], "run_id string, x double, y double")
    assert rows(reports.pressure_table(pressure), "column_no", "value_num") == [(0, None), (1, None)]
    assert c.require_metrics(wide, wide).count() == 2
    with pytest.raises(ValueError, match="no run"):
        c.require_metrics(wide, wide.where("false"))


def test_identification_report_with_psms(spark, tmp_path):
    from runlens.operators import reports
    from test_identifications import PSM, psm
    psms = spark.createDataFrame([psm("a", "1", "P1"), psm("a", "2", "P2", decoy=1)], PSM)
    peptides = spark.createDataFrame([("a",)], "run_id string")
    proteins = spark.createDataFrame([("a", "P1", None)], "run_id string, accession string, ambiguity_members string")
    report = reports.identification_report(psms, peptides, proteins, peptides, store_psms=True)
    (stored,) = report.series["identified_psms_table"].table.collect()
    assert (stored["row_no"], stored["psm_id"], stored["psm_level_fdrscore"]) == (0, "1", 0.001)
    cells = reports.series_cells(report).where("short_name = 'identified_psms_table'")
    assert cells.where("column_name = 'psm_level_fdrscore'").first()["value_num"] == 0.001 and cells.count() == 12
    sinks.write_report(report, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report" / "identified_psms_table")).count() == 1
    assert report.metrics.where("short_name = 'nr_PSMs'").first()["value_num"] == 1
