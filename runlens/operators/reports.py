"""All metrics of one kind of input at once, as metric records and tables."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.operators import features as fe
from runlens.operators import identifications as ids
from runlens.operators import spectra as sp
from runlens.operators.records import TableColumn, metric_records, metric_table
from runlens.plans.ordered import with_position
from runlens.plans.tables import write_table
from runlens.schemas import BRUKER_HEADERS, THERMO_HEADERS

# Columns of the table metrics.
CHARGE_COLUMNS = [TableColumn("charge", "MS:1000041", "charge state"),
                  TableColumn("fraction", "UO:0000191", "fraction")]
CLEAVAGE_COLUMNS = [TableColumn("missed_cleavages", "MS:1003044", "number of missed cleavages"),
                    TableColumn("fraction", "UO:0000191", "fraction")]
TIC_COLUMNS = [TableColumn("tic", "MS:1000285", "total ion current"), TableColumn("rt", "UO:0000010", "second")]
MAP_COLUMNS = [TableColumn("rt", "", "retention_time"), TableColumn("mz", "", "mz"),
               TableColumn("intensity", "", "intensity")]
RANGE_COLUMNS = [TableColumn("start", "UO:0000010", "second"), TableColumn("duration", "NCIT:C25330", "Duration")]
PRESSURE_COLUMNS = [TableColumn("x", "MS:1000894", "retention time"), TableColumn("y", "UO:0000109", "pressure unit")]
SPIKEIN_COLUMNS = [
    TableColumn("sequence", "MS:1003169", "proforma peptidoform sequence"),
    TableColumn("maximum_intensity", "MS:1001843", "MS1 feature maximum intensity"),
    TableColumn("rt_at_maximum", "MS:1000894", "retention time"),
    TableColumn("nr_identifications", "MS:1003251", "count of identified spectra"),
    TableColumn("expected_rt", "MS:1000897", "predicted retention time"),
]
CALIBRANT_COLUMNS = [
    TableColumn("calibrant_mz", "", "calibrant_mz"), TableColumn("calibrant_mobility", "", "calibrant_mobility"),
    TableColumn("observed_rt", "", "observed_calibrant_rt"), TableColumn("observed_mz", "", "observed_calibrant_mz"),
    TableColumn("observed_mobility", "", "observed_calibrant_mobility"),
]


class Series(NamedTuple):
    """A long table of typed columns, one row per row: run_id, row_no and the sources of ``columns``."""

    table: DataFrame
    columns: list[TableColumn]


class Report(NamedTuple):
    """``metrics`` (records), ``tables`` (cells of the short tables) and ``series``
    (the long tables by short name, which are not cut into cells)."""

    metrics: DataFrame
    tables: DataFrame
    series: dict[str, Series]


def series_cells(report: Report) -> DataFrame:
    """All tables of a report in cell form, for the documents; one row per cell."""
    return _union([report.tables, *[metric_table(s.table, name, s.columns, row_no="row_no") for name, s in report.series.items()]])


def _numbered(df: DataFrame, order: list[str], columns: list[TableColumn]) -> Series:
    rows = with_position(df, ["run_id"], order).withColumnRenamed("pos", "row_no")
    return Series(rows.select("run_id", "row_no", *[c.source for c in columns]), columns)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _array(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select("run_id", F.array(*[F.col(c).cast("double") for c in columns]).alias("value"))


def spectrum_report(
    spectra: DataFrame, peaks: DataFrame, minutes: float, threshold: float, max_charge: int,
    runs: DataFrame | None = None,
) -> Report:
    """Everything computed from the spectra.  ``runs`` (run_id, date, time)
    adds the start time.  The summary is stored and shared by all metrics."""
    summary = write_table(sp.spectrum_summary(spectra, peaks), "summary")
    quartiles, ratios = ["q1", "q2", "q3", "q4"], ["q2", "q3", "q4"]
    overview = sp.run_overview(summary).withColumn("rt_range", F.array("rt_first", "rt_last"))
    records = [metric_records(overview, {
        "accumulated_ms1_tic": "accumulated_MS1_TIC", "accumulated_ms2_tic": "accumulated_MS2_TIC",
        "nr_ms1": "nr_MS1", "nr_ms2": "nr_MS2", "rt_range": "RT_range",
        "base_peak_max": "base_peak_intensity_max", "tic_max": "total_ion_current_max"})]
    if runs is not None:
        records.append(metric_records(sp.run_start_time(runs), {"start_time": "startTime"}))
    arrays = [
        (sp.tic_quantile_fractions(summary), quartiles, "RT_TIC_quantiles"),
        (sp.tic_change_ratios(summary), ratios, "MS1_TIC_change_quantiles"),
        (sp.tic_quantile_ratios(summary), ratios, "MS1_TIC_quantiles"),
    ]
    frequency, density = sp.max_frequency(summary), sp.density_quantiles(summary)
    spans = sp.rt_quantile_fractions(summary)
    for level in (1, 2):
        of_level = F.col("ms_level") == level
        records.append(metric_records(frequency.where(of_level), {"freq_max": f"MS{level}_freq_max"}))
        arrays += [(spans.where(of_level), quartiles, f"RT_MS{level}_quantiles"),
                   (density.where(of_level), ["q25", "q50", "q75"], f"MS{level}_density_quantiles")]
    records += [metric_records(_array(df, columns), {"value": name}) for df, columns, name in arrays]

    maxima = sp.run_maxima_up_to(summary, minutes).withColumn("row_no", F.lit(0))
    charges = sp.precursor_charge_fractions(spectra, max_charge)
    tables = [
        metric_table(charges, "MS2_prec_charge_fraction", CHARGE_COLUMNS, row_no="charge"),
        metric_table(maxima, "base_peak_intensity_maxima_per_time_range",
                     [TableColumn("base_peak_max", "MS:1000505", "base peak intensity"), *RANGE_COLUMNS],
                     row_no="row_no"),
        metric_table(maxima, "total_ion_current_maxima_per_time_ranges",
                     [TableColumn("tic_max", "MS:1000285", "total ion current"), *RANGE_COLUMNS],
                     row_no="row_no"),
    ]
    ion_map = sp.numbered_ion_map(spectra, peaks, threshold, summary)
    series = {
        "MS1_TIC": _numbered(sp.tic_series(summary, [1]), ["scan_no"], TIC_COLUMNS),
        "MS2_TIC": _numbered(sp.tic_series(summary, [2]), ["scan_no"], TIC_COLUMNS),
        "MS1_map": Series(ion_map.select("run_id", "row_no", *[c.source for c in MAP_COLUMNS]), MAP_COLUMNS),
    }
    return Report(_union(records), _union(tables), series)


def identification_report(
    psms: DataFrame, peptides: DataFrame, proteins: DataFrame, runs: DataFrame,
    max_fdr: float = 0.01, split_members: bool = False, store_psms: bool = False,
) -> Report:
    """Everything computed from identifications, for every run of ``runs``.

    ``store_psms`` adds the table of all target PSMs before the score limit.
    """
    targets = ids.filter_target_psms(psms)
    good = write_table(ids.accepted_psms(targets, max_fdr), "psms")
    ppm = ids.ppm_summary(good, runs)
    records = [
        metric_records(ids.count_protein_groups(proteins, runs), {"nr_protein_groups": "nr_protein_groups"}),
        metric_records(ids.count_accessions(proteins, split_members, runs), {"nr_accessions": "nr_accessions"}),
        metric_records(ids.count_peptides(peptides, runs), {"nr_peptides": "nr_peptides"}),
        metric_records(ids.count_psms(good, runs), {"nr_psms": "nr_PSMs"}),
        metric_records(_array(ppm, ["ppm_q1", "ppm_q2", "ppm_q3"]), {"value": "filtered_psms_ppm_error_quartiles"}),
        metric_records(ppm, {"ppm_mean": "filtered_psms_ppm_error_mean",
                             "ppm_sigma": "filtered_psms_ppm_error_sigma"}),
    ]
    charges = ids.psm_charge_fractions(good, runs).withColumn("row_no", F.col("charge") - 1)
    tables = [
        metric_table(charges, "PSM_charge_fractions", CHARGE_COLUMNS, row_no="row_no"),
        metric_table(ids.missed_cleavage_fractions(good, runs), "PSM_missed_cleavages_fractions",
                     CLEAVAGE_COLUMNS, row_no="missed_cleavages"),
    ]
    series = {"identified_psms_table": psm_series(ids.psm_full_table(ids.group_psm_accessions(targets)))} if store_psms else {}
    return Report(_union(records), _union(tables), series)


def feature_report(features: DataFrame, max_charge: int = 5) -> Report:
    """Everything computed from quantification features."""
    counts = metric_records(fe.feature_counts(features), {
        "nr_features": "nr_features", "nr_ident_features": "nr_ident_features"})
    tables = [
        metric_table(
            fe.feature_charge_fractions(features, max_charge, identified).withColumn("row_no", F.col("charge") - 1),
            name, CHARGE_COLUMNS, row_no="row_no")
        for identified, name in ((False, "features_charges"), (True, "ident_features_charge"))]
    return Report(counts, _union(tables), {})


def psm_series(psms: DataFrame) -> Series:
    return Series(psms, [TableColumn(c, "", c) for c in psms.columns if c not in ("run_id", "row_no")])


def spikein_table(spikeins: DataFrame) -> DataFrame:
    return metric_table(spikeins, "spike_in_metrics", SPIKEIN_COLUMNS, order=["position"])


def pressure_table(points: DataFrame) -> DataFrame:
    return metric_table(points, "pump_pressure", PRESSURE_COLUMNS, order=["x", "y"])


def calibrant_table(observed: DataFrame) -> DataFrame:
    return metric_table(observed, "bruker_calibrants", CALIBRANT_COLUMNS, order=["calibrant_no", "observed_rt"])


def header_table(wide: DataFrame, vendor: str, order: list[str]) -> DataFrame:
    """Header table of a vendor (``thermo`` or ``bruker``), all columns but the run."""
    registry = {"thermo": THERMO_HEADERS, "bruker": BRUKER_HEADERS}[vendor]
    columns = [TableColumn(c, "", c) for c in wide.columns if c != "run_id"]
    return metric_table(wide, "Extracted_Headers", columns, order=order, registry=registry)
