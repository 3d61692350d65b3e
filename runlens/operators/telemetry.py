"""Instrument telemetry: header series, properties, pressure traces, calibrants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.functions.exprs import only_value, unsigned_le
from runlens.plans.ordered import asof_backward, in_slice, slice_by_order, with_carry
from runlens.plans.tables import attach, write_table

# Positions of a trace that meet in one group when its chunks do not pair up.
TRACE_CELL = 16_384

# Labels of the pump-pressure trace, the header labels read by
# default, and the default calibrants as "MZ:Mobility".
PUMP_LABELS = ("Pump_Pressure bar", "NC_Pump_Pressure bar")
PUMP_TRACE = ("NC_Pump_Pressure",)
EXTRA_HEADERS = (
    "Ion Injection Time (ms)",
    "Number of Lock Masses",
    "Lock Mass #1 (m/z)",
    "Lock Mass #2 (m/z)",
    "Lock Mass #3 (m/z)",
    "LM Search Window (ppm)",
    "LM Search Window (mmu)",
    "Last Locking (sec)",
    "LM m/z-Correction (ppm),LM Correction",
)
TUNE_HEADERS = (
    "Ion Transfer Tube Temperature (+ or +-)",
    "Ion Transfer Tube Temperature (-)",
    "Vaporizer Temp. (+ or +-)",
    "Vaporizer Temp. (-)",
)
LOG_HEADERS = (
    "Ion Transfer Tube Temperature (°C)",
    "Vaporizer Temperature (°C)",
    "Ambient temp. (°C)",
    "Orbitrap block temp. (°C)",
    "Detector temp. (°C)",
    "Ion tr. tube temp. (°C)",
    "Vaporizer temp. (°C)",
    "CPU core temp. (°C)",
    "PCB temp. top (°C)",
    "PCB temp. center (°C)",
    "PCB temp. bottom (°C)",
    "Inner Electrode Temp. (°C)",
    "Outer Electrode 1 Temp. (°C)",
    "Outer Electrode 2 Temp. (°C)",
    "MCB Ambient Temp. (°C)",
    "MCB PCB Temp. (°C)",
    "TX PCB temperature (°C)",
)
PROPERTIES = (
    "Vacuum_CurrentFore",
    "Vacuum_Extra4thGauge",
    "Vacuum_CurrentHigh",
    "Vacuum_CurrentFunnel",
    "Digitizer_CurrentTemp",
    "TOF_DeviceTempCurrentValue1",
    "TOF_DeviceTempCurrentValue2",
)
FRAME_HEADERS = ("Pressure",)
CALIBRANTS = (
    "622.0290:0.9913",
    "922.009798:1.1895",
    "1221.990637:1.3820",
)


def matching_entries(label: Column, wanted: Sequence[str]) -> Column:
    """The wanted entries a label starts with; an entry lists alternatives by comma."""
    return F.filter(F.array(*map(F.lit, wanted)),
                    lambda w: F.exists(F.split(w, ","), lambda part: F.startswith(label, part)))


def select_headers(headers: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Distinct (header, entry) pairs of each run."""
    return headers.select("run_id", "header").distinct().select(
        "run_id", "header", F.explode(matching_entries(F.col("header"), wanted)).alias("entry"))


def _named(df: DataFrame, wanted: Sequence[str], prefix: str) -> DataFrame:
    """Keep wanted headers, named by prefix and entry without slashes."""
    entry = F.explode(matching_entries(F.col("header"), wanted))
    return df.withColumn("entry", entry).withColumn(
        "name", F.replace(F.concat(F.lit(prefix), "entry"), F.lit("/"), F.lit(""))).drop("entry")


def status_records(status_log: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """run_id, rt, ``record``: at each logged time the value of every wanted
    header, the last one logged until then.

    Unwanted headers go first, so no more than the wanted ones is carried.  Of
    one header logged twice at a time the higher value counts; a NULL value is
    not a value.
    """
    keys = ["run_id", "name", "header"]
    logged = _named(status_log.where(F.col("value").isNotNull()), wanted, "LOG_")
    single = write_table(logged.groupBy(*keys, "rt").agg(F.max("value").alias("value")), "log")
    # Every header of a run at every time of it, then filled forward.
    times, labels = single.select("run_id", "rt").distinct(), single.select(*keys).distinct()
    grid = attach(times, labels, ["run_id"]).join(single, [*keys, "rt"], "left")
    at = F.when(F.col("value").isNotNull(), F.col("rt"))
    filled = with_carry(slice_by_order(grid, keys, ["rt"]), keys, lasts={"last": F.max_by("value", at)})
    here = F.last("value", ignorenulls=True).over(
        in_slice(keys, ["rt"]).rowsBetween(Window.unboundedPreceding, 0))
    filled = filled.select(*keys, "rt", F.coalesce(here, "last_before").alias("value")).where(F.col("value").isNotNull())
    return filled.groupBy("run_id", "rt").agg(
        F.array_sort(F.collect_list(F.struct("name", "header", "value"))).alias("record"))


def scan_header_table(
    scans: DataFrame, trailer: DataFrame, status_log: DataFrame,
    extra_headers: Sequence[str] = EXTRA_HEADERS, log_headers: Sequence[str] = LOG_HEADERS,
) -> DataFrame:
    """Wanted headers of every scan in long form.

    ``scans``: run_id, scan_no, rt, ms_level; ``trailer``: run_id, scan_no,
    header, value; ``status_log``: run_id, rt, header, value.  Output: run_id,
    scan_no, rt, ms_level, name, header, value.  A status value is the header's
    last one logged at or before the scan.  Every scan stays: one without any
    value has one row with NULL name, header and value.
    """
    columns = ["run_id", "scan_no", "rt", "ms_level"]
    extra = _named(trailer, extra_headers, "EXTRA_").groupBy("run_id", "scan_no").agg(
        F.collect_list(F.struct("name", "header", "value")).alias("extra"))
    records = status_records(status_log, log_headers).withColumn("scan_no", F.lit(-1).cast("bigint"))
    logged = asof_backward(scans.select(*columns), records, ["run_id"], "rt", "scan_no", ["record"])
    both = logged.join(extra, ["run_id", "scan_no"], "left")
    kind = "array<struct<name: string, header: string, value: double>>"
    cells = F.concat(*[F.coalesce(F.col(c).cast(kind), F.array().cast(kind)) for c in ("extra", "record")])
    return both.select(*columns, F.explode_outer(cells).alias("cell")).select(*columns, "cell.*")


def header_columns(table: DataFrame) -> dict[tuple[str, str], str]:
    """Column name of every (name, header) of a header table.

    A name with one header is its own column, one with several has a column for
    each, ``name [header]``.  Their number is that of the wanted labels.
    """
    pairs = [(r.name, r.header) for r in table.select("name", "header").where(
        F.col("name").isNotNull()).distinct().orderBy("name", "header").collect()]
    names = [name for name, _ in pairs]
    return {(n, h): n if names.count(n) == 1 else f"{n} [{h}]" for n, h in pairs}


def wide_headers(table: DataFrame, columns: Mapping[tuple[str, str], str] | None = None) -> DataFrame:
    """One row per scan with a column for each (name, header), as :func:`header_columns` names them.

    Scans without a value stay.  A header repeated within a scan is an error.
    """
    columns = header_columns(table) if columns is None else columns
    ids = ["run_id", "scan_no", "rt", "ms_level"]
    label = reduce(lambda c, pair: c.when((F.col("name") == pair[0][0]) & (F.col("header") == pair[0][1]), pair[1]),
                   columns.items(), F.when(F.lit(False), F.lit(None).cast("string")))
    named = table.select(*ids, label.alias("label"), "value")
    return named.groupBy(*ids).pivot("label", list(columns.values())).agg(only_value("value"))


def tune_values(tune: DataFrame, wanted: Sequence[str] = TUNE_HEADERS) -> DataFrame:
    """Selected tune values of a run, one row per (entry, header)."""
    return _named(tune, wanted, "TUNE_").select("run_id", "name", "header", "value")


def pump_pressure(
    traces: DataFrame, runs: DataFrame, labels: Sequence[str] = PUMP_LABELS, keep: str = "last"
) -> DataFrame:
    """Points of the pump-pressure trace of each run.

    ``traces``: run_id, trace_id, label, x, y.  Of several matching traces the
    last (or first) is kept; a run without one gets a single missing row.
    """
    matching = traces.where(F.col("label").isin(*labels))
    pick = F.max if keep == "last" else F.min
    chosen = matching.groupBy("run_id").agg(pick("trace_id").alias("trace_id"))
    points = attach(matching, chosen, ["run_id", "trace_id"]).select("run_id", "x", "y")
    missing = runs.select("run_id").distinct().join(chosen, "run_id", "left_anti").select(
        "run_id", F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    return points.unionByName(missing)


def place_chunks(
    chunks: DataFrame, keys: Sequence[str], order: str = "chunk_no", time_width: int = 8, value_width: int = 4
) -> DataFrame:
    """Chunks with the number of their times and values (``n_times``, ``n_values``)
    and the position of the first of each in the whole trace (``first_time``,
    ``first_value``).

    Only counts are put in order, so a trace may have any number of chunks.
    """
    counts = chunks.select(*keys, order, *[
        F.coalesce(F.ceil(F.octet_length(c) / F.lit(float(w))), F.lit(0)).cast("bigint").alias(n)
        for n, c, w in (("n_times", "times", time_width), ("n_values", "intensities", value_width))])
    rows = with_carry(slice_by_order(counts, keys, [order]), keys,
                      sums={"t": F.sum("n_times"), "v": F.sum("n_values")})
    earlier = in_slice(keys, [order]).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.select(*keys, order, "n_times", "n_values", *[
        (F.col(f"{s}_before") + F.coalesce(F.sum(n).over(earlier), F.lit(0))).cast("bigint").alias(first)
        for s, n, first in (("t", "n_times", "first_time"), ("v", "n_values", "first_value"))])
    # One row a chunk on both sides.
    return chunks.join(write_table(starts, "starts"), [*keys, order])


def _cell_pieces(chunks: DataFrame, keys: Sequence[str], numbers: Column, first: str, kind: str) -> DataFrame:
    """A chunk's numbers cut at the borders of the position cells."""
    rows = chunks.select(*keys, F.col(first).alias("first"), numbers.alias("all")).where(F.size("all") > 0)
    last = F.col("first") + F.size("all") - 1
    cells = F.sequence(F.floor(F.col("first") / F.lit(TRACE_CELL)), F.floor(last / F.lit(TRACE_CELL)))
    rows = rows.withColumn("cell", F.explode(cells))
    start = F.greatest(F.col("first"), F.col("cell") * TRACE_CELL)
    part = F.slice("all", (start - F.col("first") + 1).cast("int"),
                   (F.least(last, F.col("cell") * TRACE_CELL + TRACE_CELL - 1) - start + 1).cast("int"))
    return rows.select(*keys, "cell", F.struct(start.alias("first"), part.alias("part")).alias(kind))


def decode_packed_trace(
    chunks: DataFrame, keys: Sequence[str], time_width: int = 8, value_width: int = 4, order: str = "chunk_no"
) -> DataFrame:
    """Points of every trace: ``keys``, ``pos``, ``time``, ``value``.

    ``times`` and ``intensities`` of the chunks of a trace, put on end in
    ``order`` (unique in a trace), are two sequences of unsigned little-endian
    integers, read as doubles; a short tail of a chunk is a shorter integer.
    Their points of one position in the whole trace belong together; beyond the
    end of the shorter sequence the other side is NULL.  NULL bytes are no point.

    A chunk with as many times as values that begin at one position needs no
    other.  The numbers of the rest meet in cells of ``TRACE_CELL`` positions,
    moved as arrays, so a long trace is spread over many tasks.
    """
    placed = place_chunks(chunks, keys, order, time_width, value_width)
    times, values = unsigned_le(F.col("times"), time_width), unsigned_le(F.col("intensities"), value_width)
    alone = (F.col("first_time") == F.col("first_value")) & (F.col("n_times") == F.col("n_values"))

    pairs = F.arrays_zip(F.col("t").alias("time"), F.col("v").alias("value"))
    whole = placed.where(alone).select(*keys, "first_time", times.alias("t"), values.alias("v"))
    whole = whole.select(*keys, "first_time", F.posexplode(pairs).alias("i", "p"))
    whole = whole.select(*keys, (F.col("first_time") + F.col("i")).alias("pos"), "p.time", "p.value")

    apart = placed.where(~alone)
    pieces = _cell_pieces(apart, keys, times, "first_time", "t").unionByName(
        _cell_pieces(apart, keys, values, "first_value", "v"), allowMissingColumns=True)
    cells = pieces.groupBy(*keys, "cell").agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in "tv"])

    def numbered(parts: str) -> Column:
        """(pos, number) of all pieces on end."""
        return F.flatten(F.transform(parts, lambda p: F.transform(
            p["part"], lambda x, i: F.struct((p["first"] + i).alias("pos"), x.alias("x")))))

    # Both sides hold the same positions but for the end of the longer one.
    pairs = F.arrays_zip(numbered("t").alias("t"), numbered("v").alias("v"))
    joined = cells.select(*keys, F.explode(pairs).alias("p")).select(
        *keys, F.coalesce("p.t.pos", "p.v.pos").alias("pos"), F.col("p.t.x").alias("time"), F.col("p.v.x").alias("value"))
    return whole.unionByName(joined)


def packed_pump_pressure(
    sources: DataFrame, chunks: DataFrame, runs: DataFrame, labels: Sequence[str] = PUMP_TRACE, keep: str = "first"
) -> DataFrame:
    """Points (run_id, pos, x, y) of the pump-pressure trace of each run from packed chunks.

    ``sources``: run_id, id, description; ``chunks``: run_id, trace_id, chunk_no,
    times, intensities.  Of several sources so described the one of smallest id
    is kept (``keep="last"``: largest); a run without one, or whose trace has no
    point, gets a single missing row.
    """
    pick = F.max if keep == "last" else F.min
    chosen = sources.where(F.col("description").isin(*labels)).groupBy("run_id").agg(pick("id").alias("trace_id"))
    # Other traces are left behind before any bytes are moved.
    points = decode_packed_trace(attach(chunks, chosen, ["run_id", "trace_id"]), ["run_id", "trace_id"])
    found = points.select("run_id", "pos", F.col("time").alias("x"), F.col("value").alias("y"))
    return runs.select("run_id").distinct().join(found, "run_id", "left")


def pivot_properties(
    properties: DataFrame, definitions: DataFrame, wanted: Sequence[str] = PROPERTIES
) -> DataFrame:
    """One column per wanted property and one row per frame.

    A wanted property no run defines stays NULL everywhere.
    """
    known = definitions.where(F.col("name").isin(*wanted)).select(
        "run_id", F.col("id").alias("property_id"), "name")
    named = attach(properties, known, ["run_id", "property_id"])
    return named.groupBy("run_id", "frame").pivot("name", list(wanted)).agg(F.max("value"))


def frame_table(
    frames: DataFrame, properties_wide: DataFrame | None = None,
    optional: Sequence[str] = FRAME_HEADERS,
) -> DataFrame:
    """Id, time and type of each frame, the optional columns that exist, and
    the pivoted properties of the same frame."""
    present = [c for c in optional if c in frames.columns]
    base = frames.select("run_id", "id", "time", "msms_type", *present)
    if properties_wide is None:
        return base
    return base.join(properties_wide.withColumnRenamed("frame", "id"), ["run_id", "id"], "left")


def parse_calibrants(specs: Sequence[str]) -> list[tuple[float, float]]:
    pairs = []
    for spec in specs:
        mz, separator, mobility = spec.partition(":")
        try:
            pairs.append((float(mz), float(mobility)))
        except ValueError:
            raise ValueError(f"calibrant {spec!r} is not of the form 'MZ:Mobility'") from None
    return pairs


def track_calibrants(
    tims_peaks: DataFrame, calibrants: Sequence[str] = CALIBRANTS,
    mz_tolerance: float = 10, mobility_tolerance: float = 0.1,
) -> DataFrame:
    """Most intense MS1 peak around each calibrant at every RT.

    ``tims_peaks``: run_id, rt, mobility, precursor_idx, mz, intensity,
    position; the first of equally intense peaks is taken.  The list of
    calibrants is a parameter, so each peak is tested against it in place.
    """
    known = F.array(*[
        F.struct(F.lit(i).alias("no"), F.lit(mz).alias("mz"), F.lit(mobility).alias("mobility"))
        for i, (mz, mobility) in enumerate(parse_calibrants(calibrants), start=1)])

    def near(c: Column) -> Column:
        return ((F.col("mz") >= c["mz"] - mz_tolerance) & (F.col("mz") < c["mz"] + mz_tolerance)
                & (F.col("mobility") >= c["mobility"] - mobility_tolerance)
                & (F.col("mobility") < c["mobility"] + mobility_tolerance))

    hits = tims_peaks.where(F.col("precursor_idx") == 0).withColumn(
        "calibrant", F.explode(F.filter(known, near)))
    best = hits.groupBy("run_id", "calibrant", "rt").agg(
        F.min(F.struct((-F.col("intensity")).alias("v"), "position", "mz", "mobility")).alias("m"))
    return best.select(
        "run_id", F.col("calibrant.no").alias("calibrant_no"),
        F.col("calibrant.mz").alias("calibrant_mz"),
        F.col("calibrant.mobility").alias("calibrant_mobility"),
        F.col("rt").alias("observed_rt"), F.col("m.mz").alias("observed_mz"),
        F.col("m.mobility").alias("observed_mobility"))
