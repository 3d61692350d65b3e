"""Mixing sources to target weights by temperature.

A source's share q of all tokens becomes a weight in proportion to q^alpha.
The exponent is found by bisection: the largest one between 0 and 1 whose
weights reach a target entropy, or keep every source within a limit of
repetitions.  Weights and a token budget give each source a quota, filled by
passes over its documents in an order that is hashed anew for every pass; the
mixture is cut into blocks of equal budget, each holding every source's share,
permuted inside.

Only DataFrame functions are used.  Running sums go by slices of the hashed
order, so one source may hold any share of the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.plans.tables import write_table

# Exponents tried at once: each job narrows the interval by this factor.
GRID = 64
STEPS = 7
# Documents of a source in one slice of the hashed order, about.
SLICE_ROWS = 5_000


@dataclass(frozen=True)
class Target:
    """Give one of the two.  ``max_repetition``: most passes over any source when
    every source is used at least once.  ``entropy``: least entropy of the weights in nats.
    """

    max_repetition: float | None = 2.0
    entropy: float | None = None


def text_tokens(text: Column) -> Column:
    """Words of a text, plus one for its end; NULL counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint") + 1


def source_totals(tokens: DataFrame) -> DataFrame:
    """``source``, ``n_docs`` and ``n_tokens`` of documents (source, tokens); partial sums come before the shuffle."""
    return tokens.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("n_tokens"))


def find_exponent(totals: DataFrame, target: Target) -> float:
    """The largest exponent in [0, 1] that meets the target; 0 if none does.

    Equal totals give equal weights, so the sums run over distinct totals.
    """
    sizes = write_table(totals.groupBy(F.col("n_tokens").cast("double").alias("t")).agg(F.count(F.lit(1)).alias("n")), "sizes")
    most = sizes.agg(F.max("t").alias("most")).first().most
    if most is None:
        return 1.0
    low, high = 0.0, 1.0
    relative = F.col("t") / most

    def met(points: list[float]) -> dict[float, bool]:
        powers = sizes.select("t", "n", F.explode(F.array(*[F.lit(p) for p in points])).alias("alpha")).withColumn("w", F.pow(relative, "alpha"))
        if target.entropy is not None:
            # With Z the sum of w, the entropy is log Z - sum(w log w) / Z.
            rows = powers.groupBy("alpha").agg(F.sum(F.col("n") * F.col("w")).alias("z"), F.sum(F.col("n") * F.col("w") * F.ln("w")).alias("wlogw")).collect()
            return {r.alpha: math.log(r.z) - r.wlogw / r.z >= target.entropy for r in rows}
        # Passes over a source are in proportion to w / t; the largest source has the fewest.
        rows = powers.groupBy("alpha").agg(F.max(F.col("w") / relative).alias("most"), F.min(F.col("w") / relative).alias("least")).collect()
        return {r.alpha: r.most / r.least <= target.max_repetition for r in rows}

    if target.entropy is None:
        # A higher exponent repeats less: look for the smallest one within the limit.
        good = lambda p, found: found[p]
    else:
        good = lambda p, found: not found[p]
    for _ in range(STEPS):
        points = [low + (high - low) * k / GRID for k in range(GRID + 1)]
        found = met(points)
        # ``good`` is false, then true along the points.
        first = next((k for k, p in enumerate(points) if good(p, found)), GRID)
        low, high = points[max(0, first - 1)], points[first]
        if first == 0:
            return low
    return high if target.entropy is None else low


def source_weights(totals: DataFrame, target: Target, budget: int | None = None) -> DataFrame:
    """``totals`` with ``weight``, ``quota`` (tokens) and ``passes``.

    Without a ``budget`` it is the least with which every source is used once in full.
    """
    totals = write_table(totals, "totals")
    alpha = find_exponent(totals, target)
    top = totals.agg(F.max("n_tokens").alias("most")).first().most or 1
    powered = totals.withColumn("_w", F.pow(F.col("n_tokens") / top, F.lit(alpha)))
    sums = powered.agg(F.sum("_w").alias("z"), F.max(F.col("n_tokens") / F.col("_w")).alias("per_weight")).first()
    z = sums.z or 1.0
    scale = budget / z if budget is not None else (sums.per_weight or 0.0)
    return (powered.withColumn("alpha", F.lit(alpha)).withColumn("weight", F.col("_w") / z)
            .withColumn("quota", F.greatest(F.round(F.col("_w") * scale), F.lit(1)).cast("bigint"))
            .withColumn("passes", F.col("quota") / F.col("n_tokens")).drop("_w"))


def hashed_order(doc_id: Column, pass_no: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), pass_no.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, target: Target = Target(), budget: int | None = None, n_blocks: int = 64, seed: int = 17) -> DataFrame:
    """The mixture: columns of ``docs`` (doc_id, text, source among them) and those
    of the plan in a struct ``plan``: pass_no, block, tokens, weight, passes.

    Block b of a source's copies holds those that begin in the b-th part of its
    quota.  Every copy that begins within the quota is used in full, so a quota is
    exceeded by less than one document.  A NULL source is a source; a NULL or
    empty text counts one token; repeated rows are documents each of their own,
    in no particular order among equal ones; an empty table gives no row.  Texts
    may have any length.  Other columns may have any name; one called ``plan`` is left out.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "plan"])
    rows = docs.select(whole.alias("_doc"), "doc_id", "source", text_tokens(F.col("text").cast("string")).alias("_tokens"))
    totals = source_totals(rows.select("source", F.col("_tokens").alias("tokens")))
    weights = write_table(source_weights(totals, target, budget), "weights")
    w = weights.select(F.col("source").alias("_source"), "n_docs", "n_tokens", "quota", "weight", "passes")
    passes = F.ceil(F.col("quota") / F.col("n_tokens")).cast("int")
    copies = (rows.join(w, F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("_pass", F.explode(F.sequence(F.lit(0), passes - 1)))
              .withColumn("_order", hashed_order(F.col("doc_id"), F.col("_pass"), seed)))
    # The first 32 bits of the order, cut into slices of about equal count.
    slices = F.greatest(F.floor(F.col("n_docs") / SLICE_ROWS), F.lit(1))
    place = F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint")
    copies = copies.withColumn("_slice", F.floor(place * slices / F.lit(1 << 32)))
    keys = ["_source", "_pass", "_slice"]
    narrow = copies.groupBy(*keys).agg(F.sum("_tokens").alias("_in"))
    before = Window.partitionBy("_source").orderBy("_pass", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = narrow.select(F.col("_source").alias("_s"), F.col("_pass").alias("_p"), F.col("_slice").alias("_c"),
                           F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"))
    starts = write_table(starts, "slices")
    placed = copies.join(starts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_pass") == F.col("_p")) & (F.col("_slice") == F.col("_c")))
    inside = Window.partitionBy(*keys).orderBy("_order", "_tokens").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("_before") + F.coalesce(F.sum("_tokens").over(inside), F.lit(0))
    placed = placed.withColumn("_begin", begin).where(F.col("_begin") < F.col("quota"))
    block = F.floor(F.col("_begin") * n_blocks / F.col("quota")).cast("int")
    plan = F.struct(F.col("_pass").alias("pass_no"), block.alias("block"), F.col("_tokens").alias("tokens"),
                    F.col("_order").alias("order"), "weight", "passes")
    return placed.select("_doc.*", plan.alias("plan"))


def positions(mixture: DataFrame) -> DataFrame:
    """``mixture`` with ``position`` (from 0) in its block: documents of all sources permuted by their hash."""
    order = Window.partitionBy("plan.block").orderBy("plan.order", "doc_id", "source")
    return mixture.withColumn("position", (F.row_number().over(order) - 1).cast("bigint"))
