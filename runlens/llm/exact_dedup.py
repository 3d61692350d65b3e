"""Exact duplicates by skew-safe combining.

Texts meet their equals in three steps.  Every task first reduces its own rows
to one per text (the map side of the grouping); these meet in salted groups of
(salt, digest), where the salt is that of the task; what each salt found is
then combined per digest.  All steps group by digest *and* full text, so two
texts of one digest stay apart.  A group of copies, however large, reaches a
combining task as one row per salt.

Then every row is given its group's result.  The row carries its digest only.
Groups that hold more than 1 / ``HOT_SHARE`` of all rows, fewer than
``HOT_SHARE`` by that definition, are broadcast, so no key of the shuffled join
is larger than that.  If two texts share a digest, their rows are joined on
the text as well.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.plans.tables import write_table

# Salted groups of one text: a combining task gets at most so many rows of it.
SALTS = 256
# A group with a larger share of all rows than one in so many is joined by broadcast.
HOT_SHARE = 10_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("digest", digest(F.col("text")))


def combine(rows: DataFrame) -> DataFrame:
    """One row per text of (doc_id, text, digest): digest, text, ``keep_id`` (largest doc_id), ``group_size``."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    winners = salted.groupBy("salt", "digest", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return winners.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def _assign(members: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """Join every member (``keys``, doc_id, row) to its class; exactly one of a class is ``kept``.

    The one kept has the class's ``keep_id``; of several it is the row met last.
    """
    last = members.groupBy(*keys).agg(
        F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("keep_row"))
    # The row of the largest doc_id is one of those that repeat it, so this also settles repeated rows.
    classes = write_table(classes.join(last, keys), "classes")
    if keys != ["digest"]:
        return members.join(classes, keys)  # texts that share a digest: no bound on their size, so no broadcast
    total = F.coalesce(classes.agg(F.sum("group_size")).scalar(), F.lit(0))
    is_hot = F.col("group_size") * HOT_SHARE > total
    hot = classes.where(is_hot)
    by_broadcast = members.join(F.broadcast(hot), keys)
    by_shuffle = members.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(classes.where(~is_hot), keys)
    return by_broadcast.unionByName(by_shuffle)


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, ``keep_id`` (largest
    doc_id with an equal text), ``group_size``, ``kept`` and ``text_sha256``.

    A NULL text equals an empty one.  A NULL doc_id is below every other; a
    group of such only has a NULL ``keep_id``.  Of rows that repeat doc_id and
    text one is kept, so each group keeps one row.  Texts of any length are
    compared whole; they move twice, once per row of a task's distinct texts and
    once per row of a salt's.  An empty table gives no row.  Other columns are
    not read, whatever their names.
    """
    rows = _rows(docs, digest)
    classes = write_table(combine(rows).withColumn("sha", F.sha2("text", 256)).drop("text"), "texts")
    members = write_table(rows.select("doc_id", "digest").withColumn("row", F.monotonically_increasing_id()), "members")
    twins = write_table(classes.groupBy("digest").count().where("count > 1").select("digest"), "twins")
    if twins.isEmpty():
        found = _assign(members, classes, ["digest"])
    else:
        plain = _assign(members.join(twins, "digest", "left_anti"), classes.join(twins, "digest", "left_anti"), ["digest"])
        shared = rows.join(twins, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id())
        shared = write_table(shared, "shared")
        by_text = combine(shared).withColumn("sha", F.sha2("text", 256))
        found = plain.unionByName(_assign(shared, by_text, ["digest", "text"]).drop("text"))
    return found.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                        F.col("sha").alias("text_sha256"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each text, that of the largest doc_id.

    Of rows that repeat doc_id and text, any one stays.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    text = F.coalesce(F.col("whole.text").cast("string"), F.lit(""))
    rows = whole.select("whole", F.col("whole.doc_id").alias("doc_id"), text.alias("text"), sha256(text).alias("digest"))
    best = combine(rows).select(F.col("digest").alias("d"), F.col("text").alias("t"), "keep_id")
    same = (F.col("digest") == F.col("d")) & (F.col("text") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    kept = rows.join(best, same, "left_semi")
    return kept.dropDuplicates(["digest", "text"]).select("whole.*")
