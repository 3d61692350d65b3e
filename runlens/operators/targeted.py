"""Extracted ion chromatograms (XIC) and spike-in recovery.

``spikeins``: run_id, name, sequence (ProForma), mz, rt (s), mz_tol ("10 ppm"),
rt_tol (s), position (order in the list).  Windows of queries are in minutes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions.exprs import plain_sequence
from runlens.plans.tables import attach, fits_broadcast, lookup_join, write_table

# Width in m/z of the cells of the range join.
MZ_CELL = 0.5
# Window cells broadcast at once: rows, and bytes written out as text.
WINDOW_ROWS = 100_000
WINDOW_BYTES = 32 << 20


def xic_query_windows(spikeins: DataFrame, key: str = "plain_sequence") -> DataFrame:
    """One query per target: tolerance split from its unit, window around RT.

    Targets are keyed by plain sequence, the last of equal ones wins; with
    ``key="name"`` every name stays.
    """
    tolerance = F.split("mz_tol", " ")
    rt, half = F.col("rt") / 60.0, F.col("rt_tol") / 60.0
    queries = spikeins.select(
        "run_id", "position", plain_sequence(F.col("sequence")).alias("plain_sequence"),
        F.col("name").alias("comment"), "mz",
        tolerance[0].cast("double").alias("tolerance"),
        F.get(tolerance, F.lit(1)).alias("tolerance_unit"),
        (rt - half).alias("rt_start"), (rt + half).alias("rt_end"))
    column = "comment" if key == "name" else key
    kept = ["plain_sequence", "comment", "mz", "tolerance", "tolerance_unit", "rt_start", "rt_end"]
    last = queries.groupBy("run_id", F.col(column).alias("_key")).agg(
        F.max_by(F.struct(*kept), "position").alias("q"))
    return last.select("run_id", *[f"q.{c}" for c in kept])


def match_target_psms(psms: DataFrame, queries: DataFrame, score_max: float | None = 0.01) -> DataFrame:
    """PSMs whose sequence is a target of the run, scored below ``score_max``.

    ``None`` keeps all, for tables without the score.
    """
    rows = psms if score_max is None else psms.where(F.col("score") < score_max)
    targets = queries.select("run_id", F.col("plain_sequence").alias("sequence")).distinct()
    return attach(rows, targets, ["run_id", "sequence"])


def found_targets(matches: DataFrame) -> DataFrame:
    """Distinct RTs of every matched target: their number and mean.

    Equal RTs of one target are collapsed before anything is moved on.  Store
    the result (one row per target) when windows and counts are both wanted.
    """
    rts = matches.select("run_id", "sequence", "retention_time").distinct()
    return rts.groupBy("run_id", "sequence").agg(
        F.count("retention_time").alias("count"), F.avg("retention_time").alias("mean_rt"))


def ident_counts(found: DataFrame) -> DataFrame:
    """Number of distinct RTs per matched target; unmatched ones are absent."""
    return found.select("run_id", "sequence", "count")


def recenter_windows(queries: DataFrame, found: DataFrame) -> DataFrame:
    """Move windows to the mean RT found, keep their width; no start below 0."""
    centres = found.select("run_id", F.col("sequence").alias("plain_sequence"),
                           (F.col("mean_rt") / 60.0).alias("centre"))
    half = (F.col("rt_end") - F.col("rt_start")) / 2
    start = F.coalesce(F.col("centre") - half, "rt_start")
    return queries.join(centres, ["run_id", "plain_sequence"], "left").select(
        *[c for c in queries.columns if c not in ("rt_start", "rt_end")],
        F.greatest(F.lit(0.0), start).alias("rt_start"),
        F.coalesce(F.col("centre") + half, "rt_end").alias("rt_end"))


def mz_windows(queries: DataFrame) -> DataFrame:
    """Bounds of each query in m/z and seconds.  Only ppm is a valid unit."""
    unit_ok = F.coalesce(F.col("tolerance_unit") == "ppm", F.lit(False))
    tolerance = F.when(unit_ok, F.col("tolerance")).otherwise(
        F.raise_error(F.concat(F.lit("unsupported tolerance unit of "), F.col("comment"))).cast("double"))
    delta = F.col("mz") / 1000000 * tolerance
    return queries.select(
        "run_id", "comment", "rt_start", "rt_end",
        (F.col("mz") - delta).alias("mz_start"), (F.col("mz") + delta).alias("mz_end"))


def _window_blocks(windows: DataFrame) -> list[DataFrame]:
    """Stored windows in blocks that are small enough to be broadcast."""
    size = windows.select(F.octet_length(F.to_json(F.struct("*"))).alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes")).first()
    n = max(1, -(-size.rows // WINDOW_ROWS), -(-(size.bytes or 0) // WINDOW_BYTES))
    block = F.pmod(F.xxhash64("run_id", "comment", "cell"), F.lit(n))
    return [windows.where(block == k) for k in range(n)]


def _peaks_in_cells(peaks: DataFrame, windows: DataFrame) -> DataFrame:
    """Peaks with their m/z cell, those in cells no window touches left out.

    The set of touched cells follows the m/z range of the instrument, not the
    number of windows, and is measured by itself.
    """
    peaks = peaks.withColumn("cell", F.floor(F.col("mz") / MZ_CELL))
    touched = write_table(windows.select("cell").distinct(), "cells")
    if not fits_broadcast(touched):
        return peaks  # nearly every cell is touched
    return lookup_join(peaks, touched, ["cell"], "left_semi", broadcast=True)


def extract_xic(spectra: DataFrame, peaks: DataFrame | None, queries: DataFrame) -> DataFrame:
    """Peaks inside the m/z and RT window of each query of their run.

    Both windows are half-open.  Every peak inside is returned, not summed per
    scan; ``rt`` is in minutes.  The m/z axis is cut into cells, and only peaks
    in a cell some query touches go on.  They move once, to meet their spectrum;
    not at all if ``peaks`` is None and the spectra hold theirs as an array
    ``peaks`` of (mz, intensity).  Then the windows come to the peaks, in blocks
    of bounded size, so neither many queries nor a long run moves a peak again.
    """
    cells = F.sequence(F.floor(F.col("mz_start") / MZ_CELL), F.floor(F.col("mz_end") / MZ_CELL))
    windows = write_table(mz_windows(queries).withColumn("cell", F.explode(cells)), "windows")
    if peaks is None:
        one = spectra.select("run_id", "scan_no", "rt", F.explode("peaks").alias("p"))
        located = _peaks_in_cells(one.select("run_id", "scan_no", "rt", "p.mz", "p.intensity"), windows)
    else:
        at = spectra.select("spectrum_id", "run_id", "scan_no", "rt")
        located = _peaks_in_cells(peaks, windows).join(at, "spectrum_id")
    blocks = _window_blocks(windows)
    if len(blocks) > 1:
        located = write_table(located, "peaks")
    hits = reduce(DataFrame.unionByName, [
        located.join(F.broadcast(block), ["run_id", "cell"]).where(
            (F.col("mz") >= F.col("mz_start")) & (F.col("mz") < F.col("mz_end"))
            & (F.col("rt") >= F.col("rt_start") * 60) & (F.col("rt") < F.col("rt_end") * 60))
        for block in blocks])
    return hits.select("run_id", "comment", "scan_no", (F.col("rt") / 60.0).alias("rt"), "mz", "intensity")


def xic_arrays(points: DataFrame, queries: DataFrame) -> DataFrame:
    """One row per query with its points as two arrays, ready for the JSON sink."""
    listed = points.groupBy("run_id", "comment").agg(
        F.array_sort(F.collect_list(F.struct("rt", "scan_no", "mz", "intensity"))).alias("p"))
    rows = mz_windows(queries).join(listed, ["run_id", "comment"], "left")
    points_or_none = F.coalesce("p", F.array().cast(listed.schema["p"].dataType))
    return rows.select(
        "run_id", "comment", "mz_start", "mz_end", "rt_start", "rt_end",
        F.transform(points_or_none, lambda p: p["rt"]).alias("retention_times"),
        F.transform(points_or_none, lambda p: p["intensity"]).alias("intensities"))


def xic_apex(points: DataFrame) -> DataFrame:
    """Highest intensity of each XIC and the RT (s) of its first occurrence."""
    best = points.groupBy("run_id", "comment").agg(
        F.min(F.struct((-F.col("intensity")).alias("v"), "rt", "scan_no", "mz")).alias("m"))
    return best.select("run_id", "comment", (-F.col("m.v")).alias("maximum_intensity"),
                       (F.col("m.rt") * 60).alias("rt_at_maximum"))


def xic_apex_of_arrays(xics: DataFrame) -> DataFrame:
    """The same for XICs holding arrays: 0 and -1 if they are empty or NULL.

    ``position`` tells which of two XICs of one comment comes later and wins.
    """
    top = F.array_max("intensities")
    at = F.get(F.col("retention_times"), (F.array_position("intensities", top) - 1).cast("int"))
    has = F.coalesce(F.size("intensities") > 0, F.lit(False))
    rows = xics.select(
        "run_id", "comment", "position",
        F.when(has, top).otherwise(0.0).alias("maximum_intensity"),
        F.when(has, at * 60).otherwise(-1.0).alias("rt_at_maximum"))
    last = rows.groupBy("run_id", "comment").agg(
        F.max_by(F.struct("maximum_intensity", "rt_at_maximum"), "position").alias("x"))
    return last.select("run_id", "comment", "x.*")


def spikein_metrics(spikeins: DataFrame, apexes: DataFrame, counts: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Observed and expected values of every spike-in of a run.

    Without an XIC the apex is 0 at -1, without an identification the count 0.
    ``kept`` names further columns of the spike-ins.
    """
    targets = spikeins.select("run_id", "name", "sequence", "position", *kept,
                              plain_sequence(F.col("sequence")).alias("plain"),
                              F.col("rt").alias("expected_rt"))
    found = targets.join(apexes.withColumnRenamed("comment", "name"), ["run_id", "name"], "left")
    found = found.join(counts.withColumnRenamed("sequence", "plain"), ["run_id", "plain"], "left")
    observed = F.coalesce("rt_at_maximum", F.lit(-1.0))
    return found.select(
        "run_id", "name", "sequence", "position", *kept,
        F.coalesce("maximum_intensity", F.lit(0.0)).alias("maximum_intensity"),
        observed.alias("rt_at_maximum"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("nr_identifications"),
        "expected_rt", (observed - F.col("expected_rt")).alias("delta_to_expected_rt"))
