"""Metrics of the spectra of a run.

``spectra``: run_id, spectrum_id, scan_no, ms_level, rt (s), precursors
(array of charge and m/z).  ``peaks``: spectrum_id, mz, intensity.  File order
is ``scan_no``.  ``summary`` is the output of :func:`spectrum_summary`; store it
once (``plans.tables.write_table``) when several metrics are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.functions.exprs import bucket_counts, bucket_rows, log2_ratio, ratio, utc_text_to_epoch
from runlens.plans.ordered import in_slice, slice_by_order, with_carry
from runlens.plans.quantiles import exact_quantiles
from runlens.plans.tables import attach, write_table

# The acquisition frequency is counted over this many seconds.
FREQUENCY_WINDOW = 60
# Width of the time cells of max_frequency: at least the window above, and a
# power of two so that dividing by it is exact.
FREQUENCY_CELL = 64


def spectrum_summary(spectra: DataFrame, peaks: DataFrame) -> DataFrame:
    """TIC, base peak (0 without peaks) and number of peaks of each spectrum."""
    per_spectrum = peaks.groupBy("spectrum_id").agg(
        F.sum("intensity").alias("tic"),
        F.max("intensity").alias("base_peak"),
        F.count(F.lit(1)).alias("n_peaks"))
    return spectra.join(per_spectrum, "spectrum_id", "left").select(
        "run_id", "scan_no", "ms_level", "rt",
        F.coalesce("tic", F.lit(0.0)).alias("tic"),
        F.coalesce("base_peak", F.lit(0.0)).alias("base_peak"),
        F.coalesce("n_peaks", F.lit(0)).cast("bigint").alias("n_peaks"))


def spectrum_summary_nested(spectra: DataFrame) -> DataFrame:
    """The same from spectra carrying their peaks as an array; no shuffle."""
    intensities = F.transform("peaks", lambda p: p["intensity"])
    return spectra.select(
        "run_id", "scan_no", "ms_level", "rt",
        F.coalesce(F.aggregate(intensities, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)).alias("tic"),
        F.coalesce(F.array_max(intensities), F.lit(0.0)).alias("base_peak"),
        F.coalesce(F.array_size("peaks"), F.lit(0)).cast("bigint").alias("n_peaks"))


def _tic_of(level: int) -> Column:
    return F.sum(F.when(F.col("ms_level") == level, F.col("tic")).otherwise(0.0))


def accumulated_tic(summary: DataFrame, levels: Sequence[int] = (1, 2)) -> DataFrame:
    """Total ion current of each MS level; 0 for a run without it."""
    return summary.groupBy("run_id").agg(*[_tic_of(level).alias(f"ms{level}_tic") for level in levels])


def spectrum_counts(spectra: DataFrame) -> DataFrame:
    return spectra.groupBy("run_id").agg(
        F.count_if(F.col("ms_level") == 1).alias("nr_ms1"),
        F.count_if(F.col("ms_level") == 2).alias("nr_ms2"))


def precursor_charge_fractions(spectra: DataFrame, max_charge: int = 5) -> DataFrame:
    """Share of MS2 spectra per charge of the first precursor.

    Charge 0 is unknown, ``max_charge + 1`` stands for all above; a negative
    charge counts in the denominator only.  NULL for a run without MS2.
    """
    charge = F.get(F.col("precursors"), F.lit(0))["charge"]
    counts = bucket_counts(charge, 0, max_charge + 1, keep=F.col("ms_level") == 2)
    per_run = spectra.groupBy("run_id").agg(
        F.count_if(F.col("ms_level") == 2).alias("n"),
        *[c.alias(f"b{b}") for b, c in counts.items()])
    rows = per_run.select("run_id", "n", bucket_rows(list(counts), "charge").alias("row"))
    return rows.select("run_id", "row.charge",
                       ratio(F.col("row.count"), F.col("n")).alias("fraction"))


def rt_range(spectra: DataFrame) -> DataFrame:
    """RT of the first and the last spectrum in file order, all levels."""
    return spectra.groupBy("run_id").agg(
        F.min_by("rt", "scan_no").alias("rt_first"),
        F.max_by("rt", "scan_no").alias("rt_last"))


def run_maxima(summary: DataFrame) -> DataFrame:
    return summary.groupBy("run_id").agg(
        F.max("base_peak").alias("base_peak_max"), F.max("tic").alias("tic_max"))


def run_maxima_up_to(summary: DataFrame, minutes: float) -> DataFrame:
    """Maxima over spectra with ``rt <= minutes * 60``; whole run if not positive."""
    limit = float(minutes) * 60
    inside = F.col("rt") <= limit if limit > 0 else F.lit(True)
    return summary.groupBy("run_id").agg(
        F.max(F.when(inside, F.col("base_peak"))).alias("base_peak_max"),
        F.max(F.when(inside, F.col("tic"))).alias("tic_max"),
    ).withColumns({"start": F.lit(0.0), "duration": F.lit(limit)})


def run_overview(summary: DataFrame) -> DataFrame:
    """Counts, TIC totals, RT range and maxima of every run in one pass."""
    return summary.groupBy("run_id").agg(
        F.count_if(F.col("ms_level") == 1).alias("nr_ms1"),
        F.count_if(F.col("ms_level") == 2).alias("nr_ms2"),
        _tic_of(1).alias("accumulated_ms1_tic"),
        _tic_of(2).alias("accumulated_ms2_tic"),
        F.min_by("rt", "scan_no").alias("rt_first"),
        F.max_by("rt", "scan_no").alias("rt_last"),
        F.max("base_peak").alias("base_peak_max"),
        F.max("tic").alias("tic_max"))


def tic_series(summary: DataFrame, levels: Sequence[int] = (1, 2)) -> DataFrame:
    """(rt, TIC) of every spectrum of the levels; order by ``scan_no`` on output."""
    return summary.where(F.col("ms_level").isin(*levels)).select(
        "run_id", "ms_level", "scan_no", "rt", "tic")


def _map_peaks(spectra: DataFrame, peaks: DataFrame, threshold: float, summary: DataFrame | None) -> DataFrame:
    if summary is None:
        summary = spectrum_summary(spectra, peaks)
    highest = summary.groupBy("run_id").agg((F.max("base_peak") * threshold).alias("noise"))
    ms1 = attach(spectra.where(F.col("ms_level") == 1)
                 .select("run_id", "spectrum_id", "scan_no", "rt"), highest, ["run_id"])
    # The big table is shuffled once, on the spectrum.
    return ms1.join(peaks, "spectrum_id").where(F.col("intensity") >= F.col("noise"))


def ion_map(
    spectra: DataFrame, peaks: DataFrame, threshold: float = 0.0, summary: DataFrame | None = None
) -> DataFrame:
    """MS1 peaks of at least ``threshold`` times the run's highest intensity.

    The highest intensity is that of the whole run, all MS levels; a stored
    ``summary`` saves the pass over the peaks that finds it.
    """
    kept = _map_peaks(spectra, peaks, threshold, summary)
    return kept.select("run_id", "scan_no", "rt", "mz", "intensity")


def numbered_ion_map(
    spectra: DataFrame, peaks: DataFrame, threshold: float = 0.0, summary: DataFrame | None = None
) -> DataFrame:
    """:func:`ion_map` with ``row_no`` (from 0) in order of scan, m/z and intensity.

    The peaks of a spectrum stay together, so numbers come from a running sum
    over their counts; no peak is sorted among those of other spectra.
    """
    kept = _map_peaks(spectra, peaks, threshold, summary)
    nested = write_table(kept.groupBy("spectrum_id", "run_id", "scan_no", "rt").agg(
        F.array_sort(F.collect_list(F.struct("mz", "intensity"))).alias("p")), "map")
    keys, order = ["run_id"], ["scan_no", "spectrum_id"]
    counts = nested.select(*keys, *order, F.size("p").alias("size"))
    rows = with_carry(slice_by_order(counts, keys, order), keys, sums={"n": F.sum("size")})
    earlier = in_slice(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("n_before") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    numbered = nested.join(rows.select("run_id", "spectrum_id", first.alias("first")), ["run_id", "spectrum_id"])
    return numbered.select("run_id", "scan_no", "rt", "first", F.posexplode("p").alias("i", "peak")).select(
        "run_id", (F.col("first") + F.col("i")).cast("bigint").alias("row_no"), "scan_no", "rt", "peak.*")


def precursor_mz(spectra: DataFrame) -> DataFrame:
    """Precursor of every MS2 spectrum; ``valid`` only if there is exactly one."""
    n = F.coalesce(F.array_size("precursors"), F.lit(0))
    first = F.get(F.col("precursors"), F.lit(0))
    return spectra.where(F.col("ms_level") == 2).select(
        "run_id", "scan_no", "rt", n.alias("n_precursors"),
        (n == 1).alias("valid"), F.when(n == 1, first["mz"]).alias("mz"))


def precursor_violations(spectra: DataFrame) -> DataFrame:
    """MS2 spectra breaking the rule of exactly one precursor."""
    return precursor_mz(spectra).where(~F.col("valid")).select("run_id", "scan_no", "n_precursors")


def _duration(spectra: DataFrame) -> DataFrame:
    return rt_range(spectra).select("run_id", (F.col("rt_last") - F.col("rt_first")).alias("d"))


def rt_quantile_fractions(spectra: DataFrame, levels: Sequence[int] = (1, 2)) -> DataFrame:
    """Spans between the RT quartiles of each level, relative to the run's duration.

    The first and the last span are measured from 0 and to the duration; a run
    without the level has NULL.
    """
    keys = ["run_id", "ms_level"]
    quartiles = exact_quantiles(spectra.where(F.col("ms_level").isin(*levels)), keys, "rt")
    wanted = _duration(spectra).withColumn("ms_level", F.explode(F.array(*map(F.lit, levels))))
    joined = wanted.join(quartiles, keys, "left")
    q25, q50, q75, d = (F.col(c) for c in ("q25", "q50", "q75", "d"))
    return joined.select(*keys, ratio(q25, d).alias("q1"), ratio(q50 - q25, d).alias("q2"),
                         ratio(q75 - q50, d).alias("q3"), ratio(d - q75, d).alias("q4"))


def tic_quantile_fractions(summary: DataFrame) -> DataFrame:
    """Time spans in which each quarter of the MS1+MS2 TIC is acquired.

    Spectra are ordered by RT, on ties MS1 first, then file order; the last
    one is left out of the running total.  Spectra of one RT are summed up
    first, so a crowded RT is one row.
    """
    keys, order = ["run_id"], ["rt"]
    within_tie = F.struct("ms_level", "scan_no")
    by_rt = summary.where(F.col("ms_level").isin(1, 2)).groupBy("run_id", "rt").agg(
        F.sum("tic").alias("tic"),
        F.min_by("tic", within_tie).alias("first_tic"),
        F.max_by("tic", within_tie).alias("last_tic"))
    rows = with_carry(
        slice_by_order(by_rt, keys, order), keys,
        sums={"tic_sum": F.sum("tic")},
        lasts={"last_rt": F.max("rt"), "end_tic": F.max_by("last_tic", "rt")})

    window = in_slice(keys, order)
    after = F.col("tic_sum_before") + F.sum("tic").over(window)
    rows = rows.select(
        "run_id", "rt", "first_tic", "last_tic",
        (after - F.col("tic")).alias("before"), after.alias("after"),
        F.coalesce(F.lag("rt").over(window), F.col("last_rt_before")).alias("prev_rt"),
        F.col("last_rt_last").alias("rt_end"),
        (F.col("tic_sum_total") - F.col("end_tic_last")).alias("total"))
    end = F.when(F.col("rt") == F.col("rt_end"), F.col("after") - F.col("last_tic")).otherwise(F.col("after"))

    def crossing(p: float):
        """First RT reaching the share ``p`` and the RT of the spectrum before."""
        first_reaches = ratio(F.col("before") + F.col("first_tic"), F.col("total")) >= p
        previous = F.when(first_reaches, F.coalesce("prev_rt", "rt")).otherwise(F.col("rt"))
        return F.min(F.when(ratio(end, F.col("total")) >= p,
                            F.struct(F.col("rt").alias("at"), previous.alias("previous"))))

    crossings = rows.groupBy("run_id").agg(
        F.min("rt").alias("rt0"), F.max("rt").alias("rt_end"),
        crossing(0.25).alias("c25"), crossing(0.50).alias("c50"), crossing(0.75).alias("c75"))
    d = F.col("d")
    return _duration(summary).join(crossings, "run_id", "left").select(
        "run_id",
        ratio(F.col("c25.previous") - F.col("rt0"), d).alias("q1"),
        ratio(F.col("c50.previous") - F.col("c25.at"), d).alias("q2"),
        ratio(F.col("c75.previous") - F.col("c50.at"), d).alias("q3"),
        ratio(F.col("rt_end") - F.col("c75.at"), d).alias("q4"))


def max_frequency(spectra: DataFrame, levels: Sequence[int] = (1, 2)) -> DataFrame:
    """Highest rate of spectra of a level in any 60 s starting at a spectrum.

    Equal RTs are counted together first.  Each RT goes to its time cell and,
    as look-ahead, to the one before, so a window holds the distinct RTs of two
    cells of one run and not the run.
    """
    by_rt = spectra.where(F.col("ms_level").isin(*levels)).groupBy("run_id", "ms_level", "rt").agg(
        F.count(F.lit(1)).alias("c"))
    own = F.floor(F.col("rt") / FREQUENCY_CELL)
    cells = by_rt.withColumn("own", own).withColumn("cell", F.explode(F.array("own", F.col("own") - 1)))
    ahead = (Window.partitionBy("run_id", "ms_level", "cell").orderBy("rt")
             .rangeBetween(0, FREQUENCY_WINDOW))
    counted = cells.withColumn("in_window", F.sum("c").over(ahead)).where(F.col("cell") == F.col("own"))
    return counted.groupBy("run_id", "ms_level").agg(
        (F.max("in_window") / float(FREQUENCY_WINDOW)).alias("freq_max"))


def density_quantiles(summary: DataFrame, levels: Sequence[int] = (1, 2)) -> DataFrame:
    """Quartiles of the number of peaks per spectrum, truncated to whole numbers."""
    rows = summary.where(F.col("ms_level").isin(*levels))
    return exact_quantiles(rows, ["run_id", "ms_level"], "n_peaks").select(
        "run_id", "ms_level", *[F.col(q).cast("bigint").alias(q) for q in ("q25", "q50", "q75")])


def _log_ratios(quartiles: DataFrame) -> DataFrame:
    q25, q50, q75, top = (F.col(c) for c in ("q25", "q50", "q75", "max"))
    return quartiles.select("run_id", log2_ratio(q50, q25).alias("q2"),
                            log2_ratio(q75, q50).alias("q3"), log2_ratio(top, q75).alias("q4"))


def tic_changes(summary: DataFrame) -> DataFrame:
    """Absolute TIC difference between consecutive MS1 spectra in file order."""
    keys, order = ["run_id"], ["scan_no"]
    ms1 = summary.where(F.col("ms_level") == 1).select("run_id", "scan_no", "tic")
    rows = with_carry(slice_by_order(ms1, keys, order), keys,
                      lasts={"tic": F.max_by("tic", "scan_no")})
    previous = F.coalesce(F.lag("tic").over(in_slice(keys, order)), F.col("tic_before"))
    return rows.select("run_id", "scan_no", F.abs(previous - F.col("tic")).alias("change")).where(
        F.col("change").isNotNull())


def tic_change_ratios(summary: DataFrame) -> DataFrame:
    """log2 ratios q50/q25, q75/q50 and max/q75 of the MS1 TIC changes."""
    changes = write_table(tic_changes(summary), "changes")
    return _log_ratios(exact_quantiles(changes, ["run_id"], "change"))


def tic_quantile_ratios(summary: DataFrame) -> DataFrame:
    """The same ratios of the MS1 TIC itself."""
    return _log_ratios(exact_quantiles(summary.where(F.col("ms_level") == 1), ["run_id"], "tic"))


def run_start_time(runs: DataFrame) -> DataFrame:
    """Acquisition start in epoch seconds (UTC); -1 if missing or malformed."""
    seconds = utc_text_to_epoch(F.concat_ws(" ", "date", "time"), "yyyy-MM-dd HH:mm:ss")
    return runs.select("run_id", F.coalesce(seconds, F.lit(-1)).alias("start_time"))
