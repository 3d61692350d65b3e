"""Queries by name: ``(spark, sf_dir) -> DataFrame``.

Each reads whole tables.  Doubles are rounded to six places for comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import bindings as b
from runlens.functions.exprs import epoch_to_utc, only_value, plain_sequence
from runlens.operators import crossrun, features, identifications, records, reports, spectra, targeted, telemetry
from runlens.operators.documents import document_parts, write_documents
from runlens.plans.ordered import with_position
from runlens.plans.tables import fresh_path, write_table
from runlens.schemas import BRUKER_KEY, THERMO_KEY, Metric
from runlens.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MAX_CHARGE = 3
MINUTES = 20
NOISE = 0.9
TRACE_LIMIT = 100
CALIBRANTS = ("50:0.5", "120:0.3", "200.5:0.7")
WANTED_HEADERS = ("sign,view", "c", "purchase", "nothing")
WANTED_PROPERTIES = ("view", "click", "purchase", "missing_property")
EPOCH_OF_FIRST_DAY = 788918400
SUMMARY_SCALARS = ["nr_MS1", "nr_MS2", "accumulated_MS1_TIC", "accumulated_MS2_TIC",
                   "base_peak_intensity_max", "total_ion_current_max"]
CHARGE_COLUMNS = [f"MS2_prec_charge_fraction_{i}" for i in range(MAX_CHARGE + 2)]
SPIKEIN_COLUMNS = ["maximum_intensity", "rt_at_maximum", "nr_identifications", "delta_to_expected_rt"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: rounded(function(spark, sf_dir))
    return function


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded; adding 0.0 turns -0.0 into 0.0."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), places) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`") for f in df.schema])


def _summary(spark, d):
    return spectra.spectrum_summary(b.spectra(spark, d), b.peaks(spark, d))


def _stored_summary(spark, d):
    """For metrics that read the summary more than once."""
    return write_table(_summary(spark, d), "summary")


# ---- spectra ---------------------------------------------------------------

@query
def run_overview(spark, d):
    return spectra.run_overview(_summary(spark, d))


@query
def spectrum_summary(spark, d):
    return _summary(spark, d)


@query
def accumulated_tic(spark, d):
    return spectra.accumulated_tic(_summary(spark, d))


@query
def spectrum_counts(spark, d):
    return spectra.spectrum_counts(b.spectra(spark, d))


@query
def precursor_charge_fractions(spark, d):
    return spectra.precursor_charge_fractions(b.spectra(spark, d), MAX_CHARGE)


@query
def rt_range(spark, d):
    return spectra.rt_range(b.spectra(spark, d))


@query
def run_maxima(spark, d):
    return spectra.run_maxima(_summary(spark, d))


@query
def run_maxima_up_to(spark, d):
    return spectra.run_maxima_up_to(_summary(spark, d), MINUTES)


@query
def tic_series(spark, d):
    return spectra.tic_series(_summary(spark, d))


@query
def ion_map(spark, d):
    return crossrun.log_intensity(spectra.ion_map(b.spectra(spark, d), b.peaks(spark, d), NOISE))


@query
def precursor_check(spark, d):
    return spectra.precursor_mz(b.spectra(spark, d))


@query
def precursor_violations(spark, d):
    return spectra.precursor_violations(b.spectra(spark, d))


@query
def rt_quantile_fractions(spark, d):
    return spectra.rt_quantile_fractions(b.spectra(spark, d))


@query
def tic_quantile_fractions(spark, d):
    return spectra.tic_quantile_fractions(_stored_summary(spark, d))


@query
def max_frequency(spark, d):
    return spectra.max_frequency(b.spectra(spark, d))


@query
def density_quantiles(spark, d):
    return spectra.density_quantiles(_stored_summary(spark, d))


@query
def tic_change_ratios(spark, d):
    return spectra.tic_change_ratios(_summary(spark, d))


@query
def tic_quantile_ratios(spark, d):
    return spectra.tic_quantile_ratios(_stored_summary(spark, d))


@query
def run_start_time(spark, d):
    return spectra.run_start_time(b.runs(spark, d))


# ---- identifications -------------------------------------------------------

def _target_psms(spark, d):
    return identifications.filter_target_psms(b.psms(spark, d))


def _grouped_psms(spark, d):
    return identifications.group_psm_accessions(_target_psms(spark, d))


def _good_psms(spark, d):
    return identifications.accepted_psms(_target_psms(spark, d))


@query
def count_peptides(spark, d):
    return identifications.count_peptides(b.peptides(spark, d), b.nation_runs(spark, d))


@query
def count_protein_groups(spark, d):
    return identifications.count_protein_groups(b.proteins(spark, d), b.nation_runs(spark, d))


@query
def count_accessions(spark, d):
    return identifications.accession_counts(b.proteins(spark, d))


@query
def target_psms(spark, d):
    return _target_psms(spark, d).drop("position")


@query
def group_psm_accessions(spark, d):
    return _grouped_psms(spark, d).drop("position")


@query
def count_psms(spark, d):
    return identifications.count_psms(_good_psms(spark, d), b.nation_runs(spark, d))


@query
def ppm_error(spark, d):
    good = identifications.filter_fdr(_grouped_psms(spark, d))
    return identifications.ppm_error(good).select("run_id", "psm_id", "accession", "ppm")


@query
def ppm_summary(spark, d):
    return identifications.ppm_summary(_good_psms(spark, d))


@query
def box_summary(spark, d):
    return crossrun.box_summary(identifications.ppm_summary(_good_psms(spark, d)))


@query
def psm_charge_fractions(spark, d):
    return identifications.psm_charge_fractions(_good_psms(spark, d), b.nation_runs(spark, d))


@query
def missed_cleavage_fractions(spark, d):
    return identifications.missed_cleavage_fractions(_good_psms(spark, d), b.nation_runs(spark, d))


@query
def psm_full_table(spark, d):
    return identifications.psm_full_table(_grouped_psms(spark, d))


@query
def peptide_identifications(spark, d):
    psms = b.psms(spark, d).withColumn("score", F.col("fdr_score"))
    rows = records.peptide_identifications(psms)
    hit = F.get(F.col("hits"), F.lit(0))
    return rows.select(
        "run_id", "identifier", "rt", "mz", "score_type", "higher_score_better",
        F.size("hits").alias("n_hits"), hit["score"].alias("score"), hit["rank"].alias("rank"),
        hit["charge"].alias("charge"), hit["sequence"].alias("sequence"))


# ---- features --------------------------------------------------------------

def _features(spark, d):
    return features.features_with_idents(b.features(spark, d), b.feature_idents(spark, d))


@query
def feature_counts(spark, d):
    return features.feature_counts(_features(spark, d))


@query
def identified_features(spark, d):
    return features.identified_features(b.features(spark, d), b.feature_idents(spark, d))


@query
def feature_charge_fractions(spark, d):
    return features.feature_charge_fractions(_features(spark, d))


@query
def ident_feature_charge_fractions(spark, d):
    return features.feature_charge_fractions(_features(spark, d), identified=True)


# ---- targeted extraction ---------------------------------------------------

def _queries(spark, d):
    return targeted.xic_query_windows(b.spikeins(spark, d))


def _matches(spark, d, queries=None):
    psms = b.psms(spark, d).select("run_id", "sequence", "retention_time", "psm_id", "accession",
                                   F.col("fdr_score").alias("score"))
    return targeted.match_target_psms(psms, _queries(spark, d) if queries is None else queries)


def _found(spark, d):
    return write_table(targeted.found_targets(_matches(spark, d)), "found")


def _xic(spark, d, found=None):
    windows = targeted.recenter_windows(_queries(spark, d), _found(spark, d) if found is None else found)
    return targeted.extract_xic(b.spectra(spark, d), b.peaks(spark, d), windows)


def _spikein_metrics(spark, d, kept=()):
    found = _found(spark, d)
    return targeted.spikein_metrics(b.spikeins(spark, d), targeted.xic_apex(_xic(spark, d, found)),
                                    targeted.ident_counts(found), kept)


def _panel_metrics(spark, d):
    """The same for the list of targets the runs share."""
    panel = b.spikein_panel(spark, d)
    queries = write_table(targeted.xic_query_windows(panel), "queries")
    found = write_table(targeted.found_targets(_matches(spark, d, queries)), "found")
    points = targeted.extract_xic(b.spectra(spark, d), b.peaks(spark, d), targeted.recenter_windows(queries, found))
    return targeted.spikein_metrics(panel, targeted.xic_apex(points), targeted.ident_counts(found))


@query
def plain_sequences(spark, d):
    return b.spikeins(spark, d).select("run_id", "name", plain_sequence(F.col("sequence")).alias("plain"))


@query
def xic_query_windows(spark, d):
    return _queries(spark, d)


@query
def target_psm_matches(spark, d):
    return _matches(spark, d)


@query
def recenter_windows(spark, d):
    return targeted.recenter_windows(_queries(spark, d), targeted.found_targets(_matches(spark, d)))


@query
def ident_counts(spark, d):
    return targeted.ident_counts(targeted.found_targets(_matches(spark, d)))


@query
def extract_xic(spark, d):
    return _xic(spark, d)


@query
def extract_xic_nested(spark, d):
    windows = targeted.recenter_windows(_queries(spark, d), _found(spark, d))
    return targeted.extract_xic(b.nested_spectra(spark, d), None, windows)


@query
def xic_apex(spark, d):
    return targeted.xic_apex(_xic(spark, d))


@query
def spikein_metrics(spark, d):
    return _spikein_metrics(spark, d).drop("position")


# ---- files: written and read again ------------------------------------------

def _file(spark, name, write):
    path = fresh_path(spark, name)
    write(path)
    return path


@query
def xic_queries_file(spark, d):
    path = _file(spark, "xic_queries", lambda path: sinks.write_xic_queries(_queries(spark, d), path))
    return readers.read_xic_queries(spark, path)


def _xic_file(spark, d):
    windows = write_table(targeted.recenter_windows(_queries(spark, d), _found(spark, d)), "windows")
    xics = targeted.xic_arrays(targeted.extract_xic(b.spectra(spark, d), b.peaks(spark, d), windows), windows)
    path = _file(spark, "xic_results", lambda path: sinks.write_xic_results(xics, path))
    return readers.read_xic_results(spark, path)


@query
def xic_results_file(spark, d):
    columns = ["run_id", "comment", "mz_start", "mz_end", "rt_start", "rt_end"]
    pairs = F.arrays_zip(F.col("retention_times").alias("rt"), F.col("intensities").alias("intensity"))
    return _xic_file(spark, d).select(*columns, F.posexplode_outer(pairs).alias("i", "p")).select(*columns, "i", "p.*")


@query
def xic_apex_file(spark, d):
    """The apexes of chromatograms that come from files."""
    return targeted.xic_apex_of_arrays(_xic_file(spark, d))


@query
def ident_counts_file(spark, d):
    counts = targeted.ident_counts(targeted.found_targets(_matches(spark, d)))
    return readers.read_ident_counts(spark, _file(spark, "counts", lambda path: sinks.write_ident_counts(counts, path)))


def _whole_metrics(spark, d):
    """Metrics of whole numbers and a series of every run."""
    summary = _stored_summary(spark, d)
    series = records.metric_table(spectra.tic_series(summary, [1]), "MS1_TIC", reports.TIC_COLUMNS, order=["scan_no"])
    unnamed = records.metric_table(
        spectra.spectrum_counts(b.spectra(spark, d)).withColumn("row_no", F.lit(0)), "MS1_map",
        [records.TableColumn("nr_ms1", "", "n")], row_no="row_no", registry={"MS1_map": Metric("MS:0", "map")})
    return _metrics(spark, d, summary), write_table(series.unionByName(unnamed), "tables")


CREATED = "2024-05-05T10:00:00"


@query
def mzqc_lines(spark, d):
    return records.mzqc_lines(*_whole_metrics(spark, d), CREATED)


@query
def mzqc_file(spark, d):
    """The metrics of the documents as another reader finds them; a value is known by the hash of its text."""
    path = _file(spark, "mzqc", lambda path: sinks.write_mzqc(*_whole_metrics(spark, d), path, CREATED))
    schema = ("mzQC struct<version: string, runQualities: array<struct<metadata: struct<inputFiles: array<struct<name: string,"
              " fileProperties: array<struct<value: string>>>>>, qualityMetrics: array<struct<accession: string, name: string,"
              " value: string, unit: struct<unit_accession: string>>>>>>")
    run = F.col("mzQC.runQualities")[0]
    found = spark.read.json(path, schema=schema, multiLine=True).select(
        run["metadata"]["inputFiles"][0].alias("input"), F.explode(run["qualityMetrics"]).alias("m"))
    return found.select(
        F.col("input.name").alias("run_id"), F.get(F.col("input.fileProperties"), F.lit(0))["value"].alias("started"),
        "m.accession", "m.name", F.sha2(F.translate("m.value", "\n", ""), 256).alias("value_hash"), F.col("m.unit.unit_accession").alias("unit"))


@query
def peptide_export_file(spark, d):
    """Parts as peptide lines with commas and quotes in their cells, among lines of other kinds."""
    part = b.table(spark, d, "part")
    cell = F.concat(F.lit('"'), F.replace(F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')), F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.lit("PEPTIDE"), F.col("p_partkey").cast("string"), cell, F.lit(""), "p_type")
    lines = F.explode(F.array(F.lit("COLS_PEPTIDE,key,name,none,type"), line, F.lit("INFO,x")))
    text = part.select((F.col("p_size") % b.RUNS).cast("string").alias("run_id"), lines.alias("value"))
    path = _file(spark, "peptides", lambda path: text.write.partitionBy("run_id").text(path))
    cells = F.col("cells")
    return readers.read_peptide_export(spark, path).select(
        "run_id", F.size(cells).alias("n_cells"), *[F.get(cells, F.lit(i)).alias(f"c{i}") for i in range(5)])


@query
def spikeins_file(spark, d):
    """The list of targets as CSV files with the columns in another order."""
    table = b.spikeins(spark, d).select(
        "run_id", F.col("rt").alias("RT"), "name", F.col("mz_tol").alias("mz-tol"), "sequence", F.col("rt_tol").alias("rt-tol"), "mz")
    path = _file(spark, "spikeins", lambda path: table.write.partitionBy("run_id").option("header", True).csv(path))
    return readers.read_spikeins(spark, path).drop("position")


def _mztab(spark, d):
    """The matches and proteins of every run as an mzTab file; two runs name another score column."""
    score = F.when(F.col("run_id").isin("1", "2"), "psm_search_engine_score[2]").otherwise("psm_search_engine_score[1]")
    runs = b.spectra(spark, d).select("run_id").distinct()
    head = runs.select("run_id", F.posexplode(F.array(
        F.concat_ws("\t", F.lit("MTD"), F.lit("ms_run[1]-location"), F.concat(F.lit("file:///"), "run_id")),
        F.concat_ws("\t", F.lit("MTD"), score, F.lit("[MS, MS:1002355, PSM-level FDRScore, ]")),
        F.concat_ws("\t", F.lit("PRH"), F.lit("accession"), F.lit("ambiguity_members")))).alias("i", "line"))
    proteins = b.proteins(spark, d).select(
        "run_id", F.concat_ws("\t", F.lit("PRT"), "accession", F.coalesce("ambiguity_members", F.lit("null"))).alias("line"))
    one, two = readers.FDR_COLUMN.format(1), readers.FDR_COLUMN.format(2)
    names = [*readers.PSM_CELLS, one, two]
    second = runs.select("run_id", F.concat_ws("\t", F.lit("PSH"), *map(F.lit, names)).alias("line"))
    psms = b.psms(spark, d)
    other = F.col("run_id").isin("1", "2")
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in readers.PSM_CELLS.values()] + [
        F.when(other, "null").otherwise(F.col("fdr_score").cast("string")), F.when(other, F.col("fdr_score").cast("string")).otherwise("null")]
    rows = psms.select("run_id", F.concat_ws("\t", F.lit("PSM"), *cells).alias("line"))
    first = runs.union(proteins.select("run_id")).distinct()
    parts = [first.select("run_id", F.lit(-1).alias("section"), F.lit("COM\tfirst").alias("line")),
             head.select("run_id", F.col("i").alias("section"), "line"), proteins.select("run_id", F.lit(3).alias("section"), "line"),
             second.select("run_id", F.lit(4).alias("section"), "line"), rows.select("run_id", F.lit(5).alias("section"), "line")]
    lines = reduce(DataFrame.unionByName, parts)
    path = _file(spark, "mztab", lambda path: write_documents(document_parts(lines, ["section", "line"]), path))
    return readers.scan_mztab(spark, path)


@query
def mztab_psms_file(spark, d):
    return readers.read_psms(spark, _mztab(spark, d)).drop("position")


@query
def mztab_proteins_file(spark, d):
    lines = _mztab(spark, d)
    return readers.read_proteins(spark, lines).join(readers.read_run_names(spark, lines), "run_id", "left")


# ---- telemetry -------------------------------------------------------------

def _header_table(spark, d):
    return telemetry.scan_header_table(b.scans(spark, d), b.trailer(spark, d), b.status_log(spark, d))


@query
def select_headers(spark, d):
    headers = b.table(spark, d, "events").select(
        (F.col("user_id") % 8).cast("string").alias("run_id"), F.col("event_type").alias("header"))
    return telemetry.select_headers(headers, WANTED_HEADERS)


@query
def scan_headers_asof(spark, d):
    return _header_table(spark, d)


@query
def scan_headers_wide(spark, d):
    return telemetry.wide_headers(write_table(_header_table(spark, d), "headers"))


@query
def headers_long(spark, d):
    wide = telemetry.wide_headers(write_table(_header_table(spark, d), "headers"))
    wide = wide.withColumnsRenamed({"rt": "Scan_StartTime", "ms_level": "Scan_msLevel"}).drop("scan_no")
    return crossrun.headers_long(wide, unit="min")


@query
def tune_values(spark, d):
    return telemetry.tune_values(b.tune(spark, d))


@query
def pump_pressure(spark, d):
    return telemetry.pump_pressure(b.traces(spark, d), b.nation_runs(spark, d))


@query
def pivot_properties(spark, d):
    return telemetry.pivot_properties(b.properties(spark, d), b.property_defs(spark, d), WANTED_PROPERTIES)


@query
def frame_table(spark, d):
    wide = telemetry.pivot_properties(b.properties(spark, d), b.property_defs(spark, d), WANTED_PROPERTIES)
    return telemetry.frame_table(b.frames(spark, d), wide, ("Pressure", "Humidity"))


@query
def track_calibrants(spark, d):
    return telemetry.track_calibrants(b.tims_peaks(spark, d), CALIBRANTS)


@query
def calibrant_series(spark, d):
    return crossrun.calibrant_series(telemetry.track_calibrants(b.tims_peaks(spark, d), CALIBRANTS))


@query
def decode_trace(spark, d):
    points = telemetry.decode_packed_trace(b.trace_chunks(spark, d), ["run_id", "trace_id"])
    value, high = F.col("value").cast("bigint"), F.floor(F.col("time") / 2.0 ** 32)
    return points.groupBy("run_id", "trace_id").agg(
        F.count(F.lit(1)).alias("n_points"), F.count("time").alias("n_times"), F.count("value").alias("n_values"),
        F.max("time").alias("max_time"), F.min("time").alias("min_time"),
        F.sum(high * (F.col("pos") % 89)).alias("weighted_times"), F.sum(value * (F.col("pos") % 97)).alias("weighted_values"),
        F.sum((high % 1009) * (value % 997)).alias("paired"))


@query
def packed_pump_pressure(spark, d):
    return telemetry.packed_pump_pressure(b.trace_sources(spark, d), b.trace_chunks(spark, d), b.nation_runs(spark, d))


# ---- metric records and comparison of runs -----------------------------------

def _run_values(spark, d, summary=None):
    overview = spectra.run_overview(_summary(spark, d) if summary is None else summary)
    return overview.select(
        "run_id", "nr_ms1", "nr_ms2", "accumulated_ms1_tic", "accumulated_ms2_tic", "base_peak_max",
        "tic_max", F.array("rt_first", "rt_last").alias("rt_range"),
        (F.col("rt_first") * 86400 + EPOCH_OF_FIRST_DAY).alias("start_time"))


def _metrics(spark, d, summary=None):
    return records.metric_records(_run_values(spark, d, summary), {
        "start_time": "startTime", "rt_range": "RT_range", "nr_ms1": "nr_MS1", "nr_ms2": "nr_MS2",
        "accumulated_ms1_tic": "accumulated_MS1_TIC", "accumulated_ms2_tic": "accumulated_MS2_TIC",
        "base_peak_max": "base_peak_intensity_max", "tic_max": "total_ion_current_max"})


def _feature_metrics(spark, d):
    return records.metric_records(features.feature_counts(_features(spark, d)), {
        "nr_features": "nr_features", "nr_ident_features": "nr_ident_features"})


def _charge_table(spark, d):
    fractions = spectra.precursor_charge_fractions(b.spectra(spark, d), MAX_CHARGE)
    return records.metric_table(fractions, "MS2_prec_charge_fraction", [
        records.TableColumn("charge", "MS:1000041", "charge state"),
        records.TableColumn("fraction", "UO:0000191", "fraction")], row_no="charge")


def _maxima_table(summary):
    maxima = spectra.run_maxima_up_to(summary, MINUTES).withColumn("row_no", F.lit(0))
    return records.metric_table(maxima, "base_peak_intensity_maxima_per_time_range", [
        records.TableColumn("base_peak_max", "MS:1000505", "base peak intensity"),
        records.TableColumn("start", "UO:0000010", "second"),
        records.TableColumn("duration", "NCIT:C25330", "Duration")], row_no="row_no")


def _flat(metrics):
    """One row per element of an array value, so that rows compare in SQL."""
    return metrics.select("*", F.posexplode_outer("value_arr").alias("element_no", "element")).drop("value_arr")


@query
def metric_records(spark, d):
    return _flat(_metrics(spark, d))


@query
def metric_table_long(spark, d):
    tic = spectra.tic_series(_summary(spark, d), [1])
    return records.metric_table(tic, "MS1_TIC", [
        records.TableColumn("tic", "MS:1000285", "total ion current"),
        records.TableColumn("rt", "UO:0000010", "second")], order=["scan_no"])


REPORT_WIDTH = 3


def _report_rows(report):
    """Every value of a report: one row for each element of a metric and each row of a table, three columns at most."""
    values = F.coalesce("value_arr", F.array("value_num"))
    none = F.lit(None).cast("double")
    empty = [none.alias(f"v{i}") for i in range(1, REPORT_WIDTH)]
    rows = report.metrics.select("run_id", "short_name", F.posexplode(values).alias("row_no", "v0"), *empty, F.col("value_str").alias("text"))
    rows = rows.withColumn("row_no", F.col("row_no").cast("bigint"))
    wide = report.tables.groupBy("run_id", "short_name", "row_no").pivot("column_no", list(range(REPORT_WIDTH))).agg(only_value("value_num"))
    text = report.tables.groupBy("run_id", "short_name", "row_no").agg(F.max("value_str").alias("text"))
    wide = wide.join(text, ["run_id", "short_name", "row_no"]).select(
        "run_id", "short_name", "row_no", *[F.col(str(i)).alias(f"v{i}") for i in range(REPORT_WIDTH)], "text")
    rows = rows.unionByName(wide)
    for name, series in report.series.items():
        named = [F.col(c.source).cast("double") for c in series.columns] + [none] * REPORT_WIDTH
        rows = rows.unionByName(series.table.select(
            "run_id", F.lit(name).alias("short_name"), "row_no",
            *[c.alias(f"v{i}") for i, c in enumerate(named[:REPORT_WIDTH])], F.lit(None).cast("string").alias("text")))
    return rows


@query
def spectrum_report(spark, d):
    return _report_rows(reports.spectrum_report(
        b.spectra(spark, d), b.peaks(spark, d), MINUTES, NOISE, MAX_CHARGE))


@query
def identification_report(spark, d):
    return _report_rows(reports.identification_report(
        b.psms(spark, d), b.peptides(spark, d), b.proteins(spark, d), b.nation_runs(spark, d)))


@query
def feature_report(spark, d):
    return _report_rows(reports.feature_report(_features(spark, d)))


@query
def mzqc_metrics(spark, d):
    return _flat(records.exported_metrics(_metrics(spark, d)))


@query
def combine_runs(spark, d):
    return _flat(crossrun.combine_runs([_metrics(spark, d), _feature_metrics(spark, d)]))


@query
def combine_tables(spark, d):
    maxima = write_table(_maxima_table(_summary(spark, d)), "maxima")
    charges = features.feature_charge_fractions(_features(spark, d), 7).withColumn("row_no", F.col("charge") - 1)
    return crossrun.combine_runs([
        _charge_table(spark, d), maxima, records.metric_table(charges, "features_charges", reports.CHARGE_COLUMNS, row_no="row_no")])


@query
def combine_runs_namespaced(spark, d):
    path = F.concat(F.lit("/results/run_"), F.col("run_id"), F.lit(".features.out"))
    return _flat(crossrun.namespaced(_feature_metrics(spark, d), path))


@query
def metric_kind(spark, d):
    return crossrun.metric_kind(_metrics(spark, d), _charge_table(spark, d))


@query
def scalars_wide(spark, d):
    return crossrun.scalars_wide(_metrics(spark, d), SUMMARY_SCALARS)


@query
def arrays_wide(spark, d):
    return crossrun.arrays_wide(_metrics(spark, d), ["RT_range_min", "RT_range_max"])


@query
def tables_wide(spark, d):
    return crossrun.tables_wide(_charge_table(spark, d), ["MS2_prec_charge_fraction"], CHARGE_COLUMNS)


@query
def spikein_cells(spark, d):
    """Long form: every part is a target, too many for columns."""
    return crossrun.spikein_cells(_spikein_metrics(spark, d), SPIKEIN_COLUMNS, unit="min")


@query
def spikeins_wide(spark, d):
    """Every part is a target under its brand's name; the parts of a brand in a run stand in lists on end."""
    # A part without a brand or run is ranked too.
    group = F.to_json(F.struct("run_id", "brand"))
    targets = _spikein_metrics(spark, d, ["brand"]).withColumn("group", group)
    listed = with_position(targets, ["group"], ["position"]).withColumnRenamed("pos", "list_no")
    return crossrun.spikeins_wide(listed, SPIKEIN_COLUMNS, unit="min", label="brand", keys=["run_id", "list_no"])


def _numbered_panel(panel):
    """Row numbers of the list: the rank of the brand, the same in every run."""
    names = panel.select("name").distinct()
    return names.select((F.regexp_extract("name", r"#(\d+)", 1).cast("int") - 1).alias("row_no"), "name")


@query
def summary_table(spark, d):
    summary = _stored_summary(spark, d)
    panel = write_table(_panel_metrics(spark, d), "panel")
    names = write_table(_numbered_panel(panel), "names")
    spikeins = records.metric_table(panel.join(names, "name"), "spike_in_metrics", reports.SPIKEIN_COLUMNS, row_no="row_no")
    charges = features.feature_charge_fractions(_features(spark, d), 7).withColumn("row_no", F.col("charge") - 1)
    charges = records.metric_table(charges, "features_charges", reports.CHARGE_COLUMNS, row_no="row_no")
    label = records.metric_records(
        b.nation_runs(spark, d).distinct().withColumn("label", F.concat(F.lit("run "), "run_id")),
        {"label": "label"}, {"label": Metric("LOCAL:label", "Label")})
    cells = crossrun.summary_cells(
        _metrics(spark, d, summary).unionByName(label),
        _charge_table(spark, d).unionByName(_maxima_table(summary)).unionByName(spikeins).unionByName(charges),
        unit="min", spikein_names=names)
    order = ["startTime", "RT_range", *SUMMARY_SCALARS, "base_peak_intensity_maxima_per_time_range",
             "MS2_prec_charge_fraction", "features_charges", "spike_in_metrics", "label", "nr_peptides"]
    return crossrun.summary_table(cells, b.nation_runs(spark, d), order)


@query
def metric_catalogue(spark, d):
    both = crossrun.combine_runs([_metrics(spark, d), _feature_metrics(spark, d)], check=False)
    return crossrun.metric_catalogue(both)


@query
def vendor_check(spark, d):
    def vendor(name, key, position):
        return F.when(F.col("c_mktsegment") == name, key[position])
    keys = b.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("run_id"),
        vendor("MACHINERY", THERMO_KEY, 0).when(
            F.col("c_mktsegment") == "BUILDING", BRUKER_KEY[0]).otherwise("MS:1").alias("accession"),
        vendor("MACHINERY", THERMO_KEY, 1).when(
            F.col("c_mktsegment") == "BUILDING", BRUKER_KEY[1]).otherwise("other").alias("short_name"))
    return crossrun.vendor_check(keys)


@query
def exclude_empty_runs(spark, d):
    runs = b.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("run_id"))
    orders = b.table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("run_id"))
    return crossrun.exclude_empty_runs(runs, orders)


@query
def melt_metrics(spark, d):
    return crossrun.melt_metrics(spectra.spectrum_counts(b.spectra(spark, d)), ["nr_ms1", "nr_ms2"])


@query
def array_to_long(spark, d):
    return crossrun.array_to_long(_metrics(spark, d), "RT_range", "RT_Q")


@query
def relabel_buckets(spark, d):
    return crossrun.relabel_buckets(
        spectra.precursor_charge_fractions(b.spectra(spark, d), MAX_CHARGE), "charge")


@query
def normalise_within_run(spark, d):
    return crossrun.normalise_within_run(
        identifications.missed_cleavage_fractions(_good_psms(spark, d)), "fraction")


@query
def overlay_series(spark, d):
    return crossrun.overlay_series(spectra.tic_series(_summary(spark, d), [1]), unit="min")


@query
def scale_timestamps(spark, d):
    return crossrun.scale_timestamps(_run_values(spark, d))


@query
def start_times_utc(spark, d):
    return _run_values(spark, d).select("run_id", epoch_to_utc(F.col("start_time")).alias("startTime"))


@query
def assign_groups(spark, d):
    groups = b.table(spark, d, "nation").select(
        F.col("n_nationkey").cast("string").alias("run_id"), F.col("n_name").alias("group"))
    return crossrun.assign_groups(spectra.spectrum_counts(b.spectra(spark, d)), groups)


@query
def downsample_every_nth(spark, d):
    points = b.traces(spark, d)
    return crossrun.downsample_every_nth(points.select("run_id", "x", "y"), ["x", "y"], TRACE_LIMIT)


EMBEDDING_COLUMNS = [f"f{i}" for i in range(1, 65)]


def _scaled(spark, d):
    return crossrun.standardise_features(b.embedding_features(spark, d), EMBEDDING_COLUMNS)


@query
def standardise_features(spark, d):
    return crossrun.features_long(_scaled(spark, d), EMBEDDING_COLUMNS)


@query
def pca_scores(spark, d):
    return crossrun.pca_scores(crossrun.Components(_scaled(spark, d), EMBEDDING_COLUMNS))


@query
def pca_variance(spark, d):
    return crossrun.pca_explained_variance(crossrun.Components(_scaled(spark, d), EMBEDDING_COLUMNS))


@query
def pca_loadings(spark, d):
    return crossrun.pca_loadings(crossrun.Components(_scaled(spark, d), EMBEDDING_COLUMNS))
