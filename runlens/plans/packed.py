"""Rows of 64-bit numbers that move many at a time.

Spark spends about a microsecond on each row that it shuffles and sorts.  Where an Arrow
function makes the rows and another one takes them, they move as one row for each bucket of
keys, which holds their numbers on end.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Keys are told apart by so many bits, and a task holds so many rows, or a bucket if that has more.
BUCKET_BITS = 12
HELD = 1 << 19

Columns = tuple[np.ndarray, ...]


def schema(names: list[str]) -> str:
    return ", ".join(["bucket int", *(f"{n} binary" for n in names)])


def _batch(parts: list[tuple[np.ndarray, Columns]], names: list[str]) -> pa.RecordBatch:
    bucket = np.concatenate([b for b, _ in parts]).astype(np.int16)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
    offsets = pa.py_buffer((8 * np.append(starts, len(bucket))).astype(np.int32))
    columns = [np.concatenate(c)[order].astype(np.int64, copy=False) for c in zip(*(c for _, c in parts))]
    packed = [pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(c)]) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), *packed], ["bucket", *names])


def pack(found: Iterable[tuple[np.ndarray, Columns]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of :func:`schema` for the ``found`` buckets (16-bit numbers) and columns."""
    parts, held = [], 0
    for bucket, columns in found:
        if len(bucket):
            parts.append((bucket, columns))
            held += len(bucket)
        if held >= HELD:
            yield _batch(parts, names)
            parts, held = [], 0
    if parts:
        yield _batch(parts, names)


def gathered(packed: DataFrame) -> DataFrame:
    """Rows of :func:`schema` with those of one bucket on end in one task, for :func:`buckets`."""
    return packed.repartition("bucket").sortWithinPartitions("bucket")


def numbers(column: pa.Array) -> np.ndarray:
    """The numbers of all rows of a column."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(np.int64) if data is not None else np.empty(0, np.int64)


def buckets(batches: Iterable[pa.RecordBatch], names: list[str], most: int | None = None) -> Iterator[tuple[Columns, bool]]:
    """Columns of some whole buckets in turn, about ``HELD`` rows; of a larger one, parts of about ``most`` rows.

    The flag tells that no bucket goes on in what follows.
    """
    rows, held, last = [], 0, None

    def columns():
        return tuple(np.concatenate(c) for c in zip(*rows))

    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy()
        found = [numbers(batch.column(n)) for n in names]
        ends = np.append(0, np.cumsum(pc.binary_length(batch.column(names[0])).to_numpy().astype(np.int64)) // 8)
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1)), len(bucket))
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if held >= HELD and bucket[low] != last:
                yield columns(), True
                rows, held = [], 0
            elif most and held >= most:
                yield columns(), False
                rows, held = [], 0
            last = bucket[low]
            at = slice(int(ends[low]), int(ends[high]))
            rows.append(tuple(c[at] for c in found))
            held += at.stop - at.start
    if rows:
        yield columns(), True
