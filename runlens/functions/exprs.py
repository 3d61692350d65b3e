"""Built-in expressions with the conventions of this package."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as doubles; NULL instead of an error when dividing by zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def log2_ratio(numerator: Column, denominator: Column) -> Column:
    """log2 of a ratio; NULL if it is not positive or cannot be formed."""
    return F.log2(ratio(numerator, denominator))


def only_value(column: str) -> Column:
    """Aggregate: the one value of a group, NULL if it has none; several are an error."""
    error = F.raise_error(F.lit(f"more than one {column} for one key"))
    return F.when(F.count(column) <= 1, F.max(column)).otherwise(error)


def bucket_counts(value: Column, low: int, top: int, keep: Column | None = None) -> Mapping[int, Column]:
    """Aggregates counting value = low … top-1, and ``top`` for all above.

    Values below ``low`` fall in no bucket.  ``keep`` restricts the rows.
    """
    keep = F.lit(True) if keep is None else keep
    counts = {b: F.count_if(keep & (value == b)) for b in range(low, top)}
    counts[top] = F.count_if(keep & (value >= top))
    return counts


def bucket_rows(buckets: Sequence[int], key: str, prefix: str = "b") -> Column:
    """Explode the aggregates ``<prefix><bucket>`` to (key, count), zeros included."""
    return F.explode(F.array(*[
        F.struct(F.lit(b).alias(key), F.col(f"{prefix}{b}").alias("count")) for b in buckets]))


def plain_sequence(proforma: Column) -> Column:
    """Bare residue letters of a ProForma text.

    Drops global ``<…>``, labile ``{…}`` and bracketed ``[…]`` tags (two levels
    of nesting), the charge suffix and every other sign.
    """
    bare = F.regexp_replace(proforma, r"<[^>]*>|\{[^}]*\}", "")
    bare = F.regexp_replace(bare, r"\[[^\[\]]*\]", "")
    bare = F.regexp_replace(bare, r"\[[^\[\]]*\]", "")
    bare = F.regexp_replace(bare, r"/.*$", "")
    return F.regexp_replace(bare, r"[^A-Za-z]", "")


def unsigned_le(data: Column, width: int) -> Column:
    """Unsigned little-endian integers of ``width`` (4 or 8) bytes as an array
    of doubles; a short tail is a shorter integer.

    Spark has no cast from bytes to numbers.
    """
    return F.arrow_udf(lambda values: unpack_le(values, width), "array<double>")(data)


def unpack_le(values: pa.Array, width: int) -> pa.Array:
    """The same for an Arrow array of bytes."""
    values = values.cast(pa.large_binary())
    _, offsets, buffer = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(buffer, np.uint8)[ends[0]:ends[-1]] if buffer is not None else np.empty(0, np.uint8)
    ends = ends - ends[0]
    lengths = np.diff(ends)
    counts = -(-lengths // width)
    first = np.concatenate([[0], np.cumsum(counts)])
    # One value at a time is read in place, so nothing beside the result is as long as the data.
    numbers = np.empty(first[-1], np.float64)
    for start, length, at in zip(ends[:-1].tolist(), lengths.tolist(), first[:-1].tolist()):
        whole, tail = divmod(length, width)
        numbers[at:at + whole] = data[start:start + whole * width].view(f"<u{width}")
        if tail:
            numbers[at + whole] = int.from_bytes(data[start + length - tail:start + length].tobytes(), "little")
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(numbers),
                                    mask=values.is_null() if values.null_count else None)


def utc_text_to_epoch(text: Column, pattern: str) -> Column:
    """Epoch seconds of a UTC date-time text, whatever the session's zone; NULL
    if it cannot be read."""
    return F.unix_timestamp(F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(pattern + "X")))


def epoch_to_utc(seconds: Column) -> Column:
    """Epoch seconds as a zoneless UTC timestamp."""
    interval = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + interval


def in_unit(seconds: Column, unit: str, source_unit: str = "sec") -> Column:
    """Time in seconds or minutes (``sec``, ``min``), from these or from ``msec``."""
    if unit == source_unit and unit in ("sec", "min"):
        return seconds
    factor = {("sec", "min"): seconds / 60.0, ("min", "sec"): seconds * 60.0,
              ("msec", "sec"): seconds / 1000.0, ("msec", "min"): seconds / 60000.0}
    if (source_unit, unit) not in factor:
        raise ValueError(f"cannot convert {source_unit!r} to {unit!r}")
    return factor[(source_unit, unit)]
