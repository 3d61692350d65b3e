"""Text documents of a run, one file each, put together from parts.

A document may be long, so its lines are put in order by many tasks, and each
joins its own to parts of about ``PART_BYTES``.  A file has one writer by
nature: it gets the parts of its run in order, as a stream, and holds one at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.plans.tables import attach, write_table

PART_BYTES = 1 << 20


def finite(value: Column) -> Column:
    """NULL for numbers JSON does not have."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def _joined_lines(lines: DataFrame, order: Sequence[str], separator: str) -> DataFrame:
    """run_id, ``part``, ``text``: lines on end joined in the task that has put them in order.

    Tasks hold ranges of (run_id, order), so part numbers grow with the order.
    """
    part_bytes, between = PART_BYTES, separator + "\n"

    def run(batches):
        part = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            line = batch.column("line")
            no = batch.column("run_id").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            size = pc.binary_length(line).to_numpy(zero_copy_only=False).astype(np.int64)
            block = (np.cumsum(size) - size) // part_bytes
            new = np.append(True, (no[1:] != no[:-1]) | (block[1:] != block[:-1]))
            first = np.flatnonzero(new)
            joined = pa.ListArray.from_arrays(pa.array(np.append(first, len(line)), pa.int32()), line)
            yield pa.RecordBatch.from_arrays(
                [batch.column("run_id").take(pa.array(first)), pa.array(part + np.arange(len(first))), pc.binary_join(joined, between)],
                ["run_id", "part", "text"])
            part += len(first)

    ordered = lines.repartitionByRange("run_id", *order).sortWithinPartitions("run_id", *order)
    return ordered.select("run_id", "line").mapInArrow(run, "run_id string, part bigint, text string")


def document_parts(
    lines: DataFrame, order: Sequence[str], head: str = "", tail: str = "", separator: str = "",
    runs: DataFrame | None = None,
) -> DataFrame:
    """run_id, ``part``, ``text`` from lines (run_id, ``line`` and the columns of ``order``).

    The parts of a run on end are ``head``, its lines in order with
    ``separator`` between them, and ``tail``.  A run of ``runs`` without a line
    has head and tail only.  A part is longer than ``PART_BYTES`` by one line at
    most.  Lines move once, to be put in order; the parts are stored only if a
    run's first and last must be known.
    """
    lines = lines.where(F.col("line").isNotNull() & F.col("run_id").isNotNull())
    parts = _joined_lines(lines, order, separator)
    if head or tail or separator:
        parts = write_table(parts, "parts")
        ends = parts.groupBy("run_id").agg(F.min("part").alias("first"), F.max("part").alias("last"))
        text = F.concat(
            F.when(F.col("part") == F.col("first"), F.lit(head)).otherwise(F.lit(separator)), "text",
            F.when(F.col("part") == F.col("last"), F.lit(tail)).otherwise(F.lit("")))
        parts = attach(parts, ends, ["run_id"]).select("run_id", "part", text.alias("text"))
    if runs is None:
        return parts
    empty = runs.select("run_id").distinct().join(lines.select("run_id"), "run_id", "left_anti")
    return parts.unionByName(empty.select("run_id", F.lit(0).cast("bigint").alias("part"), F.lit(head + tail).alias("text")))


def write_documents(parts: DataFrame, path: str) -> None:
    """One folder ``run_id=…`` with one text file for each run."""
    parts.repartition("run_id").sortWithinPartitions("run_id", "part").select(
        "run_id", F.col("text").alias("value")).write.partitionBy("run_id").text(path)
