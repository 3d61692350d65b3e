"""Intermediate tables and joins with a small side.

A derived table that several jobs read is written once to the shared folder
named by ``spark.checkpoint.dir`` and read back.  That cuts the lineage, so a
lost executor costs one re-read and not the whole job, and it gives Spark the
true size of the table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only if it was measured and holds at most so many rows and
# so many bytes, written out as text.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20

# Copies of the small side and shares of every key of the big side when the
# small side is too large to broadcast.
SALTS = 32

# Spark's setting that deletes the shuffle files of a query when it has ended; they stay until the driver's next
# garbage collection otherwise.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="runlens-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder of the shared one that is not there yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of it.

    What was shuffled for it goes once it is written.
    """
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(table: DataFrame) -> None:
    """Delete what :func:`write_table` wrote, once nothing will read ``table`` or what is derived from it."""
    spark = table.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _size() -> list[Column]:
    text = F.octet_length(F.to_json(F.struct("*")))
    return [F.count(F.lit(1)).alias("rows"), F.sum(text.cast("bigint")).alias("bytes")]


def _fits(rows: int, size: int | None, rows_per_row: int) -> bool:
    return rows * rows_per_row <= BROADCAST_ROWS and (size or 0) * rows_per_row <= BROADCAST_BYTES


def fits_broadcast(table: DataFrame, rows_per_row: int = 1) -> bool:
    """True if ``table`` (a written one, so reading it is cheap) is small enough.

    ``rows_per_row`` is how many rows the caller derives from each.
    """
    size = table.agg(*_size()).first()
    return _fits(size.rows, size.bytes, rows_per_row)


def write_measured(df: DataFrame, name: str = "table", rows_per_row: int = 1) -> tuple[DataFrame, bool]:
    """:func:`write_table` and :func:`fits_broadcast` in one job."""
    seen = Observation()
    table = write_table(df.observe(seen, *_size()), name)
    return table, _fits(seen.get["rows"], seen.get["bytes"], rows_per_row)


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    broadcast: bool = False,
) -> DataFrame:
    """Equi-join ``big`` to a smaller table without gathering one key in a task.

    With ``broadcast`` (only after :func:`fits_broadcast`) no row of ``big``
    moves.  Otherwise every key of ``big`` is spread over ``SALTS`` shares and
    ``small`` is repeated once per share; the result is the same.
    """
    on = list(on)
    if broadcast:
        return big.join(F.broadcast(small), on, how)
    hashable = [F.col(f"`{f.name}`") for f in big.schema if "map<" not in f.dataType.simpleString()]
    # Equal rows are told apart by the partition they come from.
    share = F.pmod(F.xxhash64(*hashable) + F.spark_partition_id(), F.lit(SALTS))
    salted = big.withColumn("_salt", share)
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = copies.withColumn("_salt", F.col("_salt").cast("bigint"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def attach(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Write ``small``, check its size, then :func:`lookup_join`."""
    table, fits = write_measured(small, "lookup")
    return lookup_join(big, table, on, how, broadcast=fits)
