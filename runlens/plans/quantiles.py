"""Exact quantiles of groups of any size, by radix selection.

In every round the rows around the wanted positions are counted in
2 ** ``DIGIT_BITS`` buckets, and of each position the bucket that holds it is
kept.  A position is found when its bucket has one value.  The first buckets
divide the range of the group evenly, which is enough for most; the next ones
go by the bits of a double, read as an integer of the same order, so a few
rounds are enough for any.  Rows are only counted, never sorted or gathered,
whatever the size of a group; counting combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from runlens.plans.tables import lookup_join, write_measured, write_table

# Bits of a round: a group has about 2 ** DIGIT_BITS counts for each position at most.
DIGIT_BITS = 14

QUARTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}


def ordered_bits(value: Column) -> Column:
    """A bigint ordered like the doubles (its bits for positive ones, their
    negative otherwise); both zeros are 0, NaN is above infinity."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.abs(value)).cast("bigint")
    return F.when(value < 0, -bits).otherwise(bits)


def _with_shift(df: DataFrame, low: str, high: str) -> DataFrame:
    """Add ``shift``, the fewest bits to drop so that one round tells the values from low to high apart."""
    df = df.withColumns({"_low": ordered_bits(F.col(low)), "_high": ordered_bits(F.col(high))})

    def apart(s: Column) -> Column:
        return F.call_function("shiftright", F.col("_high"), s) - F.call_function("shiftright", F.col("_low"), s)
    # Without a shift the difference may not fit a bigint, halves do.
    fits = F.filter(F.sequence(F.lit(1), F.lit(63)), lambda s: apart(s) < (1 << DIGIT_BITS))
    shift = F.when(apart(F.lit(1)) < (1 << (DIGIT_BITS - 1)) - 1, 0).otherwise(F.element_at(fits, 1))
    return df.withColumn("shift", shift).drop("_low", "_high")


def _select(rows: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts rows (keys, v, parent, digit) and keeps the bucket of each position:
    its least and largest value, and how many rows of the group are ``below``."""
    counts = rows.groupBy(*keys, "parent", "digit").agg(
        F.count(F.lit(1)).alias("size"), F.min("v").alias("low"), F.max("v").alias("high"))
    order = Window.partitionBy(*keys, "parent").orderBy("digit")  # at most one row for each digit
    placed = counts.withColumn("before", F.sum("size").over(order) - F.col("size"))
    start = F.col("below") + F.col("before")
    found = targets.join(placed, [*keys, "parent"]).where(
        (start <= F.col("position")) & (F.col("position") < start + F.col("size")))
    return found.select(*keys, "position", "low", "high", start.alias("below"))


def values_at(rows: DataFrame, groups: DataFrame, keys: Sequence[str], positions: Column, small: bool) -> DataFrame:
    """keys, ``position``, ``value``: the value at each position (from 0, in order) of a group.

    ``rows``: keys, v (no NULL).  ``groups``: keys, n, min, max, stored; ``small``
    says that they fit a broadcast.
    """
    keys = list(keys)
    v, base, span = F.col("v"), F.col("base"), F.col("span")
    info = _with_shift(groups, "min", "max").select(
        *keys, F.col("min").alias("base"), (F.col("max") - F.col("min")).alias("span"), "shift")
    even = F.floor((v - base) / span * (1 << DIGIT_BITS))
    digit = F.when(span == 0, F.lit(0)).when(span < float("inf"), even).otherwise(
        F.call_function("shiftright", ordered_bits(v), F.col("shift")))
    counted = lookup_join(rows, info, keys, broadcast=small).select(*keys, "v", F.lit(0.0).alias("parent"), digit.alias("digit"))
    targets = groups.select(*keys, F.explode(F.array_distinct(positions)).alias("position"),
                            F.lit(0.0).alias("parent"), F.lit(0).cast("bigint").alias("below"))
    found, around = [], rows
    while True:
        # The number of open positions comes with the job that writes them.
        seen, is_open = Observation(), F.col("low") != F.col("high")
        state = _select(counted, targets, keys).observe(seen, F.count_if(is_open).alias("open"))
        state = write_table(state, "positions")
        found.append(state.where(~is_open))
        if not seen.get["open"]:
            break
        state = state.where(is_open)
        targets = state.select(*keys, "position", F.col("low").alias("parent"), "below")
        wanted = _with_shift(state, "low", "high").groupBy(*keys).agg(
            F.collect_set(F.struct("low", "high", "shift")).alias("buckets"))
        own = F.get(F.filter("buckets", lambda b: (v >= b["low"]) & (v <= b["high"])), F.lit(0))
        kept = lookup_join(around, wanted, keys, broadcast=small).withColumn("own", own).where(F.col("own").isNotNull())
        kept = kept.select(*keys, "v", F.col("own.low").alias("parent"), F.col("own.shift").alias("shift"))
        if around is rows:
            # From here on only the rows around the positions are read.
            kept = write_table(kept, "around")
            around = kept.select(*keys, "v")
        counted = kept.withColumn("digit", F.call_function("shiftright", ordered_bits(v), F.col("shift"))).drop("shift")
    result = reduce(DataFrame.unionByName, found)
    return result.select(*keys, "position", F.col("low").alias("value"))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float] = QUARTILES
) -> DataFrame:
    """Per key: ``n``, ``min``, ``max`` and each quantile, linearly interpolated.

    NULL values are skipped; a key with none left is absent.  ``df`` is read
    two or three times, so hand in a stored table or a cheap plan.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    groups, small = write_measured(rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max")), "groups", rows_per_row=2 * len(probs))
    at = {q: (F.col("n") - 1) * F.lit(float(p)) for q, p in probs.items()}
    positions = F.array(*[end(x).cast("bigint") for x in at.values() for end in (F.floor, F.ceil)])
    found = values_at(rows, groups, keys, positions, small)
    listed = groups.join(found.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("position", "value"))).alias("of")), keys)

    def interpolated(position: Column) -> Column:
        low = F.element_at("of", F.floor(position).cast("bigint"))
        high = F.element_at("of", F.ceil(position).cast("bigint"))
        return low + (high - low) * (position - F.floor(position))

    return listed.select(*keys, "n", "min", "max", *[interpolated(x).alias(q) for q, x in at.items()])
