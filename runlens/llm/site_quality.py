"""Quality classifier: document evidence combined with its site, by hierarchical empirical Bayes.

A logistic model, fitted in numpy on a bounded sample of labelled documents,
gives every text a probability of being of low quality.  Sums of these per path
and host (grouped aggregates, so a host with a third of all rows is no matter)
give Beta posteriors: a host's rate is shrunk toward the rate of all documents, a
path's toward its host's, the more the fewer documents it has.  How much is
estimated from the spread between hosts and between paths.  A document's
log odds move by the log odds of its path against those of all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.textblocks import Block, blocks, repeated, within_text
from runlens.plans.tables import write_table

# Bound of the training sample: labelled documents of each class.
SAMPLE_DOCS = 4_000


def _bytes(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_LEAD = (np.arange(256) & 0xC0) != 0x80
_TABLES = {
    "symbols": _bytes("#*$%&<>@^~=_{}[]\\/"), "bars": _bytes("|"), "bangs": _bytes("!?"), "digits": _bytes("0123456789"),
    "capitals": _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "stops": _bytes(".,;:"),
}


def text_features(block: Block) -> np.ndarray:
    """One row of numbers per text of a block; an empty text has zeros but the last."""
    n = block.n_texts
    words = np.diff(block.first_word)
    some = np.maximum(words, 1)
    chars = block.count(_LEAD)
    columns = [block.count(t) / np.maximum(chars, 1) for t in _TABLES.values()]
    text, h = block.text_of_word, block.word_hash
    follows = np.zeros(len(h), bool)
    follows[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    columns.append(np.bincount(text[follows], minlength=n) / some)
    windows, at = block.shingles(4)
    twice = at[repeated(within_text(windows, text[at]))]
    columns.append(np.bincount(text[twice], minlength=n) / some)
    columns.append(np.log1p(chars / some))
    columns.append(np.log1p(words) / 10)
    columns.append((words == 0).astype(float))
    return np.stack(columns, axis=1)


@dataclass
class Logistic:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 30) -> Logistic:
    """Newton steps on the ridge-penalised log likelihood; ``y`` 1 is low quality."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    a = np.append(np.clip((x - centre) / scale, -8, 8), np.ones((len(x), 1)), axis=1)
    w = np.zeros(a.shape[1])
    penalty = np.full(len(w), ridge * len(x) / 100 + 1e-3)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + penalty * w
        curve = (a * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ a + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return Logistic(centre, scale, w)


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Logistic | None:
    """Fit on at most ``sample_docs`` labelled documents of each class, those of
    smallest hash.  None if a class has none.

    A doc_id labelled differently counts as low quality; a NULL label as none.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"))
    order = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = known.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample_docs).drop("_rank")
    # The side is bounded by the sample's size.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column("text")):
                part = batch.slice(block.first_row, block.n_texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"), pa.array(list(text_features(block)), pa.list_(pa.float64()))],
                    ["doc_id", "quality", "x"])

    # Repeated rows of a doc_id are one example.
    found = rows.mapInArrow(run, "doc_id bigint, quality int, x array<double>").dropDuplicates(["doc_id"])
    found = sorted(found.collect())
    y = np.array([1 - r.quality for r in found])
    if len(set(y.tolist())) < 2:
        return None
    return fit_logistic(np.array([r.x for r in found]), y)


def document_evidence(docs: DataFrame, model: Logistic | None, host: Column, path: Column, carry: list[str]) -> DataFrame:
    """Columns ``carry`` of ``docs`` as a struct ``row``, ``host``, ``path`` and ``p_text``; no shuffle."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), host.cast("string").alias("host"),
                       path.cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("p_text", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column("text")):
                part = batch.slice(block.first_row, block.n_texts)
                p = model.probability(text_features(block)) if model else np.full(block.n_texts, 0.5)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(p)],
                                                 ["row", "host", "path", "p_text"])

    return rows.mapInArrow(run, schema)


def _strength(groups: DataFrame, n: str, total: str, parent: Column | float) -> Column:
    """Prior weight (in documents) by moments: the less groups differ beyond
    chance, the more they are shrunk; between 1 and 10,000."""
    mean = F.col(total) / F.col(n)
    p = parent if isinstance(parent, Column) else F.lit(parent)
    excess = F.sum(F.col(n) * (mean - p) ** 2 - p * (1 - p)) / F.sum(F.col(n) - 1)
    within = F.sum(F.col(n) * p * (1 - p)) / F.sum(n)
    return F.least(F.greatest(F.coalesce(F.try_divide(within, F.greatest(excess, F.lit(1e-9))), F.lit(10_000.0)),
                              F.lit(1.0)), F.lit(10_000.0))


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """Per path: ``host``, ``path``, ``n_host``, ``n_path``, ``p_all``, ``p_host`` and ``p_path``."""
    paths = write_table(evidence.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n_path"), F.sum("p_text").alias("low_path")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("low_path").alias("low_host"))
    totals = hosts.agg(F.sum("low_host") / F.sum("n_host")).first()[0]
    p_all = min(max(totals, 1e-4), 1 - 1e-4) if totals is not None else 0.5
    k_host = hosts.agg(_strength(hosts, "n_host", "low_host", p_all)).first()[0]
    hosts = hosts.withColumn("p_host", (F.col("low_host") + k_host * p_all) / (F.col("n_host") + k_host))
    # Hosts and paths may be NULL; those are one host or path of their own.
    left, right = paths.alias("p"), hosts.alias("h")
    both = left.join(right, F.col("p.host").eqNullSafe(F.col("h.host"))).select(
        "p.host", "p.path", "n_path", "low_path", "n_host", "p_host")
    k_path = both.agg(_strength(both, "n_path", "low_path", F.col("p_host"))).first()[0]
    return both.withColumn("p_all", F.lit(p_all)).withColumn(
        "p_path", (F.col("low_path") + k_path * F.col("p_host")) / (F.col("n_path") + k_path))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, carry: list[str],
             threshold: float = 0.5, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Columns ``carry`` of every row of ``docs`` in a struct ``row``, the
    posteriors, ``score`` (probability of low quality) and ``kept`` (score below
    ``threshold``).

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality (1 good, 0
    low).  A NULL text counts as empty and is judged like one.  NULL hosts form one
    host, NULL paths one path of their host.  Equal rows get equal results, one
    each.  Without labels of both classes every text has evidence 0.5 and is
    kept.  An empty table gives no row.
    """
    model = fit(docs, labels, sample_docs)
    evidence = write_table(document_evidence(docs, model, host, path, carry), "evidence")
    sites = site_posteriors(evidence)
    e, s = evidence.alias("e"), sites.alias("s")
    joined = e.join(s, F.col("e.host").eqNullSafe(F.col("s.host")) & F.col("e.path").eqNullSafe(F.col("s.path")))
    odds = lambda p: F.ln(p / (1 - p))
    text = F.least(F.greatest(F.col("p_text"), F.lit(1e-9)), F.lit(1 - 1e-9))
    z = odds(text) + odds(F.col("p_path")) - odds(F.col("p_all"))
    score = 1 / (1 + F.exp(-z)) if model else F.lit(0.5)
    kept = (score < threshold) if model else F.lit(True)
    return joined.select("row", "e.host", "e.path", "n_host", "n_path", "p_text", "p_all", "p_host", "p_path",
                         score.alias("score"), kept.alias("kept"))
