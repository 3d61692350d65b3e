"""Comparing runs: combined metrics, summary tables, long series, PCA."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import PCA, ElementwiseProduct, PCAModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.functions.exprs import epoch_to_utc, in_unit, only_value, ratio
from runlens.plans.ordered import with_position
from runlens.plans.tables import write_table
from runlens.schemas import (
    BRUKER_KEY,
    SPIKEIN_DELTA,
    SPIKEIN_EXPECTED_RT,
    SPIKEIN_LABEL,
    SPIKEIN_RT,
    SPIKEIN_TABLE,
    SUMMARY_ORDER,
    SUMMARY_TABLES,
    THERMO_KEY,
)

# Rows kept of long series, and metadata of a combined file.
TRACE_POINTS = 10_000
COMBINED_METADATA = {
    "mzQC_format_version": "1.2",
    "mzQC_data_version": "4.1.18",
    "mzQC_URL": "https://raw.githubusercontent.com/HUPO-PSI/psi-ms-CV/321d7731f683557c5aecf6e5f7fefe049da0ecbf/psi-ms.obo",
}
# Headers shown for MS1 only, columns that are no series, and
# tables of which the summary shows one value.
MS1_ONLY_HEADERS = ("EXTRA_Ion Injection Time (ms)", "EXTRA_LM mz-Correction (ppm),LM Correction")
NO_SERIES = ("MsMsType", "Scan_msLevel")
TIME_HEADERS = ("Scan_StartTime", "Time")
FIRST_VALUE_TABLES = (
    "base_peak_intensity_maxima_per_time_range", "total_ion_current_maxima_per_time_ranges")
# Fixed value: a single-valued key that is not a scalar metric.
SKIPPED_KEYS = ("LOCAL:05|filtered_psms_ppm_error",)


# ---- combining -----------------------------------------------------------

def duplicate_keys(metrics: DataFrame) -> DataFrame:
    """Metric keys a run holds more than once."""
    return metrics.groupBy("run_id", "accession", "short_name").agg(
        F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def _unique(df: DataFrame, keys: Sequence[str], message: str) -> DataFrame:
    """``df``, whose rows each have a key of their own; reading a repeated key is an error."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    checked = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(F.lit(message)))
    return one.select(*keys, checked.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def combine_runs(parts: Sequence[DataFrame], check: bool = True) -> DataFrame:
    """All metrics, or all cells of metric tables, of several outputs.

    With ``check`` a key repeated within a run (of a table: a cell) is an error
    when the result is read; the check is part of the plan.
    """
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if not check:
        return combined
    keys = ["run_id", "accession", "short_name"]
    if "column_no" in combined.columns:
        return _unique(combined, [*keys, "row_no", "column_no"], "a table cell occurs more than once in a run")
    return _unique(combined, keys, "a metric key occurs more than once in a run")


def namespaced(metrics: DataFrame, path: Column) -> DataFrame:
    """Put metrics under the stem of their file: the name up to the first dot."""
    return metrics.withColumn("run_id", F.substring_index(F.substring_index(path, "/", -1), ".", 1))


def combined_metadata(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        *[F.lit(v).alias(k) for k, v in COMBINED_METADATA.items()],
        F.current_date().cast("string").alias("creation_date"))


# ---- inventory of the metrics --------------------------------------------

def metric_kind(metrics: DataFrame, metric_tables: DataFrame | None = None) -> DataFrame:
    """Kind of every metric over all runs: a single value in every run is a
    scalar, more values in any run make an array, tables are tables."""
    size = F.coalesce(F.array_size("value_arr"), F.lit(1))
    key = F.concat_ws(" ! ", "accession", "short_name")
    kinds = metrics.where(~key.isin(*SKIPPED_KEYS)).groupBy("accession", "short_name").agg(
        F.when(F.max(size) == 1, "scalar").otherwise("array").alias("kind"))
    if metric_tables is None:
        return kinds
    tables = metric_tables.select("accession", "short_name").distinct()
    return kinds.unionByName(tables.withColumn("kind", F.lit("table")))


def metric_catalogue(metrics: DataFrame, ordered: bool = True) -> DataFrame:
    """Every metric key with its attributes, as the first run having it gives them."""
    attributes = ["description", "name", "short_name", "unit_accession", "unit_name"]
    key = F.concat_ws(" ! ", "accession", "short_name").alias("key")
    catalogue = metrics.groupBy(key).agg(
        F.min_by(F.struct(*attributes), "run_id").alias("a")).select("key", "a.*")
    return catalogue.orderBy("key") if ordered else catalogue


def vendor_check(keys: DataFrame) -> DataFrame:
    """Runs carrying the header table of each vendor; ``mixed`` if both occur."""
    def has(key):
        return (F.col("accession") == key[0]) & (F.col("short_name") == key[1])
    per_run = keys.groupBy("run_id").agg(
        F.bool_or(has(THERMO_KEY)).alias("thermo"), F.bool_or(has(BRUKER_KEY)).alias("bruker"))
    return per_run.agg(
        F.count_if("thermo").alias("n_thermo"),
        F.count_if(F.col("bruker") & ~F.col("thermo")).alias("n_bruker"),
    ).withColumn("mixed", (F.col("n_thermo") > 0) & (F.col("n_bruker") > 0))


def require_one_vendor(keys: DataFrame) -> None:
    if vendor_check(keys).first()["mixed"]:
        raise ValueError("runs of two vendors cannot be compared")


def exclude_empty_runs(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    return runs.join(metrics.select("run_id"), "run_id", "left_semi")


def empty_runs(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    return runs.join(metrics.select("run_id"), "run_id", "left_anti")


def require_metrics(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Runs having metrics; an error if none has."""
    kept = exclude_empty_runs(runs, metrics)
    if kept.isEmpty():
        raise ValueError("no run has any metric")
    return kept


# ---- wide tables ---------------------------------------------------------

def scalars_wide(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per run; a metric repeated within a run is an error."""
    scalars = metrics.where(F.col("short_name").isin(*names))
    return scalars.groupBy("run_id").pivot("short_name", list(names)).agg(only_value("value_num"))


def array_cells(metrics: DataFrame) -> DataFrame:
    """Elements of array metrics as (run_id, metric, part, column, value):
    ``<metric>_1`` …; for RT_range ``_min`` and ``_max``."""
    elements = metrics.where(F.array_size("value_arr") > 1).select(
        "run_id", F.col("short_name").alias("metric"), F.posexplode("value_arr").alias("i", "value"))
    range_suffix = F.when(F.col("i") == 0, "min").otherwise("max")
    suffix = F.when(F.col("metric") == "RT_range", range_suffix).otherwise((F.col("i") + 1).cast("string"))
    return elements.select("run_id", "metric", F.col("i").cast("double").alias("part"),
                           F.concat_ws("_", "metric", suffix).alias("column"), "value")


def arrays_wide(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    return array_cells(metrics).groupBy("run_id").pivot("column", list(columns)).agg(only_value("value"))


def table_cells(metric_tables: DataFrame, names: Sequence[str]) -> DataFrame:
    """Two-column tables as (run_id, metric, part, column, value): the first
    column is the suffix, the first value of a key is taken."""
    rows = metric_tables.where(F.col("short_name").isin(*names)).groupBy(
        "run_id", F.col("short_name").alias("metric"), "row_no").agg(
        F.max(F.when(F.col("column_no") == 0, F.col("value_num"))).alias("key"),
        F.max(F.when(F.col("column_no") == 1, F.col("value_num"))).alias("value"))
    whole = F.col("key") == F.rint("key")
    suffix = F.when(whole, F.col("key").cast("bigint").cast("string")).otherwise(F.col("key").cast("string"))
    return rows.groupBy("run_id", "metric", F.col("key").alias("part"), F.concat_ws("_", "metric", suffix).alias("column")).agg(
        F.min_by("value", "row_no").alias("value"))


def tables_wide(metric_tables: DataFrame, names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    cells = table_cells(metric_tables, names)
    return cells.groupBy("run_id").pivot("column", list(columns)).agg(only_value("value"))


def first_value_cells(metric_tables: DataFrame, names: Sequence[str] = FIRST_VALUE_TABLES) -> DataFrame:
    first = (F.col("row_no") == 0) & (F.col("column_no") == 0) & F.col("short_name").isin(*names)
    return metric_tables.where(first).select(
        "run_id", F.col("short_name").alias("metric"), F.lit(0.0).alias("part"),
        F.col("short_name").alias("column"), F.col("value_num").alias("value"))


def spikein_table_cells(metric_tables: DataFrame, names: DataFrame | None = None, unit: str = "sec") -> DataFrame:
    """The spike-in tables of all runs as (run_id, metric, part, label, column, value, text).

    A column is ``<label>_<column of the table>``; one more holds the difference
    to the expected time.  The label is the sequence or, with ``names`` (row_no,
    name: the spike-in list in its order), the name; the second of equal labels
    in a run is ``<label> #2``, and so on.
    """
    cell = F.struct("column_no", "column_name", "value_num", "value_str")
    rows = metric_tables.where(F.col("short_name") == SPIKEIN_TABLE).groupBy("run_id", "row_no").agg(
        F.array_sort(F.collect_list(cell)).alias("cells"))

    def of(name: str, field: str) -> Column:
        return F.get(F.filter("cells", lambda x: x["column_name"] == name), F.lit(0))[field]

    rows = rows.withColumn("label", of(SPIKEIN_LABEL, "value_str"))
    if names is not None:
        given = names.select("row_no", F.col("name").alias("given"))
        rows = rows.join(given, "row_no", "left").withColumn("label", F.coalesce("given", "label"))
    same = Window.partitionBy("run_id", "label").orderBy("row_no")
    rows = rows.withColumn("copy", F.row_number().over(same))
    label = F.when(F.col("copy") > 1, F.concat("label", F.lit(" #"), "copy")).otherwise(F.col("label"))
    rt, expected = of(SPIKEIN_RT, "value_num"), of(SPIKEIN_EXPECTED_RT, "value_num")
    delta = F.struct(F.size("cells").alias("column_no"), F.lit(SPIKEIN_DELTA).alias("column_name"),
                     (rt - expected).alias("value_num"), F.lit(None).cast("string").alias("value_str"))
    kind = "array<struct<column_no: int, column_name: string, value_num: double, value_str: string>>"
    every = F.explode(F.concat(F.col("cells").cast(kind), F.array(delta).cast(kind))).alias("c")
    long = rows.select("run_id", "row_no", label.alias("label"), every)
    is_time = F.col("c.column_name").isin(SPIKEIN_RT, SPIKEIN_EXPECTED_RT, SPIKEIN_DELTA)
    return long.select(
        "run_id", F.lit(SPIKEIN_TABLE).alias("metric"), (F.col("row_no") * 1000.0 + F.col("c.column_no")).alias("part"),
        "label", F.concat_ws("_", "label", "c.column_name").alias("column"),
        F.when(is_time, in_unit(F.col("c.value_num"), unit)).otherwise(F.col("c.value_num")).alias("value"),
        F.col("c.value_str").alias("text"))


def spikein_cells(
    spikeins: DataFrame, columns: Sequence[str], unit: str = "sec", label: str = "name", keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Requested values of each spike-in as (``keys``, ``<label>_<column>``, value)."""
    times = ("rt_at_maximum", "expected_rt", "delta_to_expected_rt")
    values = [(in_unit(F.col(c), unit) if c in times else F.col(c)).cast("double").alias(c) for c in columns]
    shown = spikeins.select(*keys, F.col(label).alias("label"), *values)
    return shown.unpivot([*keys, "label"], list(columns), "what", "value").select(
        *keys, F.concat_ws("_", "label", "what").alias("column"), "value")


def spikeins_wide(
    spikeins: DataFrame, columns: Sequence[str], unit: str = "sec", label: str = "name", labels: Sequence[str] | None = None,
    keys: Sequence[str] = ("run_id",),
) -> DataFrame:
    """One row per run; the labels are those of the data unless given, a label
    repeated within a run is an error.

    One column per label and value, so this is for lists the runs share.  A run
    with several lists has a row for each if ``keys`` tells them apart.
    """
    cells = write_table(spikein_cells(spikeins, columns, unit, label, keys), "spikeins")
    if labels is None:
        names = [x["column"] for x in cells.select("column").distinct().orderBy("column").collect()]
    else:
        names = [f"{x}_{c}" for x in labels for c in columns]
    return cells.groupBy(*keys).pivot("column", names).agg(only_value("value"))


def summary_cells(
    metrics: DataFrame, metric_tables: DataFrame, unit: str = "sec", tables: Sequence[str] = SUMMARY_TABLES,
    spikein_names: DataFrame | None = None,
) -> DataFrame:
    """All summary values as (run_id, metric, part, column, value, text, label).

    Scalars (numbers and texts), arrays, two-column tables, first values and
    spike-ins go in one long table, so the summary takes one shuffle however
    many metrics there are.  ``part`` orders the columns of a metric, those of
    one ``label`` (a spike-in) stay together.
    """
    scalars = metrics.where(F.coalesce(F.array_size("value_arr"), F.lit(1)) == 1).select(
        "run_id", F.col("short_name").alias("metric"), F.lit(0.0).alias("part"), F.col("short_name").alias("column"),
        F.coalesce("value_num", F.get(F.col("value_arr"), F.lit(0))).alias("value"), F.col("value_str").alias("text"))
    arrays = array_cells(metrics)
    arrays = arrays.withColumn("value", F.when(
        F.col("column").isin("RT_range_min", "RT_range_max"), in_unit(F.col("value"), unit)
    ).otherwise(F.col("value")))
    parts = [arrays, table_cells(metric_tables, tables), first_value_cells(metric_tables),
             spikein_table_cells(metric_tables, spikein_names, unit)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, scalars)


def summary_columns(cells: DataFrame, order: Sequence[str] | None = None) -> list[tuple[str, bool]]:
    """Columns of the summary, and whether they hold texts, as the cells have them.

    ``order`` lists metrics; each stands for all its columns in any run, one
    that no run has for a column of its own.  Read once; as many rows as the
    summary has columns.
    """
    found = cells.groupBy("metric", F.coalesce("label", F.lit("")).alias("label"), "column").agg(
        F.min("part").alias("part"), F.bool_or(F.col("text").isNotNull()).alias("is_text")).collect()
    first = {}
    for x in found:
        if x.label:
            first[x.metric, x.label] = min(x.part, first.get((x.metric, x.label), x.part))
    columns = []
    for metric in SUMMARY_ORDER if order is None else order:
        own = sorted((first.get((metric, x.label), 0.0), x.label, x.part, x.column, x.is_text) for x in found if x.metric == metric)
        columns += [(name, is_text) for *_, name, is_text in own] or [(metric, False)]
    return columns


def summary_table(
    cells: DataFrame, runs: DataFrame, order: Sequence[str] | None = None, ordered: bool = True
) -> DataFrame:
    """One row per run with the columns of the metrics in ``order`` (:func:`summary_columns`).

    Two values of one cell are an error.  ``startTime`` becomes a timestamp (UTC).
    """
    cells = write_table(cells, "cells")
    columns = summary_columns(cells, order)
    names = [name for name, _ in columns]
    wide = cells.groupBy("run_id").pivot("column", names).agg(
        only_value("value").alias("number"), only_value("text").alias("text"))
    quoted = [(c, c.replace("`", "``"), is_text) for c, is_text in columns]
    shown = [F.coalesce(f"`{q}_text`", F.col(f"`{q}_number`").cast("string")).alias(c) if is_text
             else F.col(f"`{q}_number`").alias(c) for c, q, is_text in quoted]
    wide = runs.select("run_id").distinct().join(wide.select("run_id", *shown), "run_id", "left")
    if "startTime" in names:
        wide = wide.withColumn("startTime", epoch_to_utc(F.col("startTime")))
    return wide.orderBy("run_id") if ordered else wide


# ---- long forms ----------------------------------------------------------

def melt_metrics(wide: DataFrame, columns: Sequence[str], ids: Sequence[str] = ("run_id",)) -> DataFrame:
    return wide.unpivot(list(ids), list(columns), "variable", "value")


def array_to_long(metrics: DataFrame, short_name: str, prefix: str) -> DataFrame:
    elements = metrics.where(F.col("short_name") == short_name).select(
        "run_id", F.posexplode("value_arr").alias("i", "value"))
    return elements.select(
        "run_id", F.concat(F.lit(prefix + "_"), F.col("i") + 1).alias("variable"), "value")


def relabel_buckets(buckets: DataFrame, key: str, unknown: bool = True) -> DataFrame:
    """Highest bucket of a run becomes ``more`` and, on request, 0 ``Unknown``."""
    tops = buckets.groupBy("run_id").agg(F.max(key).alias("_top"))
    label = F.when(F.col(key) == F.col("_top"), "more")
    if unknown:
        label = label.when(F.col(key) == 0, "Unknown")
    joined = buckets.join(tops, ["run_id"])
    return joined.withColumn(key, label.otherwise(F.col(key).cast("string"))).drop("_top")


def normalise_within_run(df: DataFrame, value: str) -> DataFrame:
    """Share of each row in its run's total."""
    totals = df.groupBy("run_id").agg(F.sum(value).alias("_total"))
    return df.join(totals, ["run_id"]).withColumn(
        value, ratio(F.col(value), F.col("_total"))).drop("_total")


def overlay_series(series: DataFrame, time: str = "rt", unit: str = "sec", source_unit: str = "sec") -> DataFrame:
    """Series of all runs with the time axis in the wanted unit."""
    return series.withColumn(time, in_unit(F.col(time), unit, source_unit))


def box_summary(ppm: DataFrame) -> DataFrame:
    return ppm.select("run_id", F.col("ppm_q1").alias("q1"), F.col("ppm_q2").alias("median"),
                      F.col("ppm_q3").alias("q3"), F.col("ppm_mean").alias("mean"),
                      F.col("ppm_sigma").alias("sd"))


def downsample_every_nth(
    series: DataFrame, order: Sequence[str], max_points: int = TRACE_POINTS
) -> DataFrame:
    """Every n-th row of a run longer than ``max_points``, starting at its first."""
    step = F.greatest(F.floor(F.col("n") / F.lit(max_points)), F.lit(1))
    keep = (F.col("n") <= max_points) | (F.col("pos") % step == 0)
    return with_position(series, ["run_id"], order).where(keep).select(*series.columns)


def log_intensity(df: DataFrame) -> DataFrame:
    """log10 of the intensity; NULL where it is not positive."""
    return df.withColumn("log_intensity", F.log10("intensity"))


def headers_long(
    wide: DataFrame, time_column: str | None = None, level: str = "Scan_msLevel", unit: str = "sec"
) -> DataFrame:
    """Header table to (run_id, header, x, y), missing values left out.

    Two headers are shown for MS1 scans only and say so in their name.
    """
    time = time_column or next((c for c in TIME_HEADERS if c in wide.columns), None)
    if time is None:
        raise ValueError("the header table has no time column")
    skipped = {"run_id", time, level, *NO_SERIES}
    names = sorted(c for c in wide.columns if c not in skipped)
    ids = ["run_id", time] + ([level] if level in wide.columns else [])
    typed = wide.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    long = typed.unpivot(ids, [f"`{c}`" for c in names], "header", "y").where(F.col("y").isNotNull())
    if level in wide.columns:
        # A name with several labels carries the label in brackets.
        only = reduce(lambda a, b: a | b, [(F.col("header") == h) | F.startswith("header", F.lit(f"{h} [")) for h in MS1_ONLY_HEADERS])
        long = long.where(~only | (F.col(level) == 1)).withColumn(
            "header", F.when(only, F.concat("header", F.lit(" (MS1 filtered)"))).otherwise(F.col("header")))
    return long.select("run_id", "header", in_unit(F.col(time).cast("double"), unit).alias("x"), "y")


def calibrant_series(observed: DataFrame, unit: str = "sec") -> DataFrame:
    """Observed m/z and mobility of each numbered calibrant over time.

    Observed times are in milliseconds.
    """
    return observed.select(
        "run_id", F.col("calibrant_no").alias("no"), "calibrant_mz", "calibrant_mobility",
        in_unit(F.col("observed_rt"), unit, "msec").alias("rt"), "observed_mz", "observed_mobility")


# ---- scaling and principal components -------------------------------------

def scale_timestamps(runs: DataFrame, column: str = "start_time") -> DataFrame:
    """Start times as a percentage between the first and the last; 1 if equal."""
    ends = runs.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("e"))
    low, high = F.col("_ends.low"), F.col("_ends.high")
    scaled = ratio(F.col(column) - low, high - low) * 100
    return runs.withColumn("_ends", ends.scalar()).select(
        "run_id", F.when(high == low, 1.0).otherwise(scaled).alias("t_scaled"))


def assign_groups(runs: DataFrame, run_groups: DataFrame) -> DataFrame:
    return runs.join(run_groups.select("run_id", "group"), ["run_id"], "left")


def standardise_features(wide: DataFrame, columns: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Missing values filled, then z-scores with the population deviation.

    A constant column becomes 0.  Output: run_id, features (vector in the order
    of ``columns``).
    """
    filled = wide.selectExpr("run_id", *[
        f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {fill!r}D) AS `{c}`"
        for c in columns])
    assembled = VectorAssembler(inputCols=list(columns), outputCol="raw").transform(filled)
    rows = write_table(assembled.select("run_id", "raw"), "features")
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="sample").fit(rows)
    # The scaler divides by the sample deviation.
    n = rows.count()
    factor = math.sqrt(n / (n - 1)) if n > 1 else 0.0
    to_population = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * len(columns)), inputCol="sample", outputCol="features")
    return to_population.transform(scaler.transform(rows)).select("run_id", "features")


def features_long(scaled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardised features as (run_id, variable, value)."""
    names = F.array(*map(F.lit, columns))
    values = scaled.select("run_id", F.posexplode(vector_to_array("features")).alias("i", "value"))
    return values.select("run_id", F.get(names, F.col("i")).alias("variable"), "value")


class Components:
    """Principal components of standardised features.

    A component's sign is free; it is chosen so that its largest loading (in
    magnitude, the first on ties) is positive.
    """

    def __init__(self, scaled: DataFrame, columns: Sequence[str], k: int = 2):
        self.columns = list(columns)
        self.rows = write_table(scaled, "scaled")
        self.model: PCAModel = PCA(k=k, inputCol="features", outputCol="pca").fit(self.rows)
        loadings = self.model.pc.toArray()
        self.loadings = []
        self.signs = []
        for j in range(k):
            column = [float(x) for x in loadings[:, j]]
            sign = 1.0 if max(column, key=abs) >= 0 else -1.0
            self.signs.append(sign)
            self.loadings.append([sign * x for x in column])


def pca_scores(components: Components, start_times: DataFrame | None = None) -> DataFrame:
    """``pca1``, ``pca2``, … of every run and, if given, its scaled start time."""
    values = components.model.transform(components.rows).select("run_id", vector_to_array("pca").alias("v"))
    scores = values.select(
        "run_id", *[(F.col("v")[j] * s).alias(f"pca{j + 1}") for j, s in enumerate(components.signs)])
    if start_times is None:
        return scores
    return scores.join(scale_timestamps(start_times), "run_id", "left")


def pca_explained_variance(components: Components) -> DataFrame:
    """Share of each component and the percentage shown on an axis."""
    spark = components.rows.sparkSession
    shares = [float(x) for x in components.model.explainedVariance]
    return spark.createDataFrame(
        [(j + 1, x) for j, x in enumerate(shares)], "component int, ratio double"
    ).withColumn("percent", F.round(F.col("ratio") * 100, 1))


def pca_loadings(components: Components) -> DataFrame:
    """Loadings of every variable on the first two components, longest first."""
    spark = components.rows.sparkSession
    pc1, pc2 = components.loadings[:2]
    rows = [(c, math.hypot(x, y), x, y) for c, x, y in zip(components.columns, pc1, pc2)]
    return spark.createDataFrame(rows, "variable string, length double, PC1 double, PC2 double").orderBy(
        F.desc("length"))
