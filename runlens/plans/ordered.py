"""Running values over one long ordered run.

A window partitioned by ``run_id`` alone would sort a whole run in one task.
Here the rows are range-partitioned by (keys, order) instead, which cuts a long
run into many slices.  Each slice is summarised in one row, a window over those
few rows gives what every slice inherits from the ones before it, and the
window over the rows themselves stays inside a slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from runlens.plans.tables import write_table

SLICE = "slice"


def slice_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add the number of the range partition; numbers grow with the order.

    The result is a written table: range bounds are sampled, so the numbers
    must be fixed before they are used twice.
    """
    ranged = df.repartitionByRange(*keys, *order)
    return write_table(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def with_carry(
    sliced: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Join to every row what its slice inherits.

    ``sums`` maps a name to an aggregate: adds ``<name>_before`` (total of the
    earlier slices) and ``<name>_total`` (total of the key).  ``lasts`` maps a
    name to an aggregate giving the last value of a slice, NULL if it has none:
    adds ``<name>_before`` (last one of the earlier slices) and ``<name>_last``
    (last one of the key).
    """
    sums, lasts = sums or {}, lasts or {}
    aggregates = [c.alias(n) for n, c in {**sums, **lasts}.items()]
    per_slice = sliced.groupBy(*keys, SLICE).agg(*aggregates)
    # At most one row per slice and key, so this window stays small.
    whole = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(
        *keys, SLICE,
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in sums],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in sums],
        *[F.last(n, ignorenulls=True).over(before).alias(f"{n}_before") for n in lasts],
        *[F.last(n, ignorenulls=True).over(whole).alias(f"{n}_last") for n in lasts],
    )
    # Same keys as the window inside a slice: both use one shuffle.
    return sliced.join(carried, [*keys, SLICE])


def in_slice(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """Window over the rows of one slice."""
    return Window.partitionBy(*keys, SLICE).orderBy(*order)


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``pos`` (0, 1, … in ``order``) and ``n`` (rows) per key."""
    carried = with_carry(slice_by_order(df, keys, order), keys, {"_n": F.count(F.lit(1))})
    pos = F.col("_n_before") + F.row_number().over(in_slice(keys, order)) - 1
    return (carried.withColumn("pos", pos.cast("bigint"))
            .withColumn("n", F.col("_n_total").cast("bigint"))
            .drop("_n_before", "_n_total", SLICE))


def asof_backward(
    left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, tie: str, payload: Sequence[str]
) -> DataFrame:
    """Give each row of ``left`` the ``payload`` of the last ``right`` row of
    its key at or before its ``time``; NULL if there is none.

    ``tie`` is a column of both sides ordering rows of equal time; it also lets
    a crowded moment be cut.
    """
    rest = [c for c in left.columns if c not in (*keys, time, tie)]
    found = F.struct(*payload)
    events = right.select(*keys, time, F.lit(0).alias("side"), tie, found.alias("found"),
                          *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in rest])
    probes = left.select(*keys, time, F.lit(1).alias("side"), tie,
                         F.lit(None).cast(events.schema["found"].dataType).alias("found"), *rest)
    order = [time, "side", tie]
    sliced = slice_by_order(events.unionByName(probes), keys, order)
    # Rows of the left side have no order here, and max_by skips those.
    at = F.when(F.col("side") == 0, F.struct(time, tie))
    rows = with_carry(sliced, keys, lasts={"found": F.max_by("found", at)})
    last = F.last("found", ignorenulls=True).over(
        in_slice(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("found", F.coalesce(last, "found_before")).where(F.col("side") == 1)
    return rows.select(*left.columns, *[F.col("found")[c].alias(c) for c in payload])
