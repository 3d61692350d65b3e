"""Hard negatives by segment summary filtering.

A vector is cut into equal segments; of each its mean and its deviation (root
of the summed squares around the mean) are stored.  Of two vectors, a segment
of m components adds m * mean * mean to the inner product, give or take
deviation * deviation at most, so the sums over the segments bound the score
from both sides.  Bounds are taken with one segment, then with more and
shorter ones for the pairs still open; what is left is scored exactly.  A pair
is closed if its upper bound is below the anchor's worst kept score, or its
lower bound above the largest score wanted.

Two searches run one after the other: the nearest rows of the anchor's label
(the positives), then, with their scores as limits, the best rows of other
labels.  Anchors are cut into blocks and every block is met by all rows, dealt
into ``SHARES`` shares; a task streams one share past one block and keeps the
best of each anchor, so its memory is that of a block and a batch.  Blocks,
and so tasks, grow with the anchors; what a share returns is bounded by the
anchors alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.plans.tables import write_table

# Segments of a vector at each refinement; each number divides the next.
LEVELS = (1, 4, 16)
# Anchors of a block, and shares of the rows that meet it.
BLOCK_ANCHORS = 8_192
SHARES = 32
# Rows and anchors of one bound matrix, pairs scored at once, and the share of open pairs beyond which whole matrices are cheaper.
BATCH_ROWS = 2_048
BATCH_ANCHORS = 256
BATCH_PAIRS = 32_768
DENSE = 1 / 16
# Products and sums below this are exact as doubles.
EXACT = float(1 << 53)
LARGEST = (1 << 63) - 1

FOUND = "anchor bigint, probe int, row_no bigint, vec_id bigint, score bigint"


def scaled_rows(vectors: DataFrame, scale: float, label: Column) -> DataFrame:
    """``row_no``, vec_id, label and ``v`` (floor of scale * x) of the rows that take part, stored.

    Left out are rows with a NULL label or vector, or a NULL or non-finite
    component.  Rows equal in vec_id, label and vector count once.
    """
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", label.cast("bigint").alias("label"), x.alias("x"))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))).distinct()
    v = F.transform("x", lambda c: F.floor(c * scale))
    return write_table(rows.select(F.monotonically_increasing_id().alias("row_no"), F.col("vec_id").cast("bigint").alias("vec_id"),
                                   "label", v.alias("v")), "vectors")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of integers; short ones end in zeros."""
    offsets = lists.offsets.to_numpy()
    values = np.asarray(lists.values.to_numpy(zero_copy_only=False), np.int64)
    lengths = np.diff(offsets)
    if len(lengths) and (lengths == width).all():
        return values[offsets[0]:offsets[-1]].reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    for k in range(len(lengths)):
        out[k, :lengths[k]] = values[offsets[k]:offsets[k + 1]]
    return out


def summaries(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean (times the root of the length) and deviation of every segment of every row."""
    parts = x.reshape(len(x), segments, -1)
    mean = parts.sum(axis=2) / np.sqrt(parts.shape[2])
    return mean, np.sqrt(np.maximum((parts * parts).sum(axis=2) - mean * mean, 0))


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows a[i] and b[j]."""
    out = np.empty(len(i), np.result_type(a, b))
    for k in range(0, len(i), BATCH_PAIRS):
        out[k:k + BATCH_PAIRS] = np.einsum("ij,ij->i", a[i[k:k + BATCH_PAIRS]], b[j[k:k + BATCH_PAIRS]])
    return out


class _Rows:
    """Vectors with their summaries; ``wide`` says that doubles cannot hold the products."""

    def __init__(self, batch: pa.Table, width: int):
        column = lambda name: batch[name].combine_chunks()
        ints = _matrix(column("v"), width)
        self.row_no = column("row_no").to_numpy()
        self.label = column("label").to_numpy()
        self.no_id = column("vec_id").is_null().to_numpy(zero_copy_only=False)
        self.vec_id = column("vec_id").fill_null(0).to_numpy(zero_copy_only=False)
        self.ints = ints
        self.x = ints.astype(float)
        self.largest = float(np.abs(self.x).max(initial=0))
        padded = np.zeros((len(ints), max(1, -(-width // LEVELS[-1])) * LEVELS[-1]))
        padded[:, :width] = self.x
        self.levels = [summaries(padded, s) for s in LEVELS]
        self.norm = float(np.sqrt((self.x * self.x).sum(axis=1)).max(initial=0))

    def __len__(self) -> int:
        return len(self.row_no)


def open_pairs(anchors: _Rows, rows: _Rows, mask: np.ndarray, low: np.ndarray, high: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``mask`` (anchors from ``first`` on, rows) whose bounds leave low <= score <= high possible."""
    slack = 0.5 + 1e-12 * anchors.norm * rows.norm
    part = slice(first, first + len(mask))
    low, high = low - slack, high + slack
    i = j = None
    for (am, ad), (rm, rd) in zip(anchors.levels, rows.levels):
        if i is None:
            middle, spread = am[part] @ rm.T, ad[part] @ rd.T
            mask &= (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
            if mask.sum() <= DENSE * mask.size:
                i, j = np.nonzero(mask)
        else:
            middle, spread = _products(am, rm, i + first, j), _products(ad, rd, i + first, j)
            keep = (middle + spread >= low[i]) & (middle - spread <= high[i])
            i, j = i[keep], j[keep]
    return np.nonzero(mask) if i is None else (i, j)


def scores(anchors: _Rows, rows: _Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact integer products; those beyond a long become the largest or least one."""
    if len(i) == 0:
        return np.empty(0, np.int64)
    if anchors.x.shape[1] * anchors.largest * rows.largest < EXACT:
        first, last = int(i.min()), int(i.max()) + 1
        if len(i) > DENSE * (last - first) * len(rows):
            return (anchors.x[first:last] @ rows.x.T)[i - first, j].astype(np.int64)
        return _products(anchors.x, rows.x, i, j).astype(np.int64)
    exact = (sum(p * q for p, q in zip(a, b)) for a, b in zip(anchors.ints[i].tolist(), rows.ints[j].tolist()))
    return np.fromiter((max(-LARGEST, min(LARGEST, s)) for s in exact), np.int64, len(i))


class _Kept:
    """The best ``keep`` candidates of every probe; a probe is an anchor with limits to the score."""

    def __init__(self, low: np.ndarray, high: np.ndarray, keep: int):
        self.low, self.high, self.keep = low, high, keep
        self.worst = low.copy()
        none = np.empty(0, np.int64)
        self.probe, self.score, self.no_id, self.vec_id, self.row_no = none, none, np.empty(0, bool), none, none

    def add(self, probe, score, no_id, vec_id, row_no) -> None:
        inside = (score >= self.worst[probe]) & (score <= self.high[probe])
        if not inside.any():
            return
        new = (probe, score, no_id, vec_id, row_no)
        old = (self.probe, self.score, self.no_id, self.vec_id, self.row_no)
        both = [np.concatenate([a, b[inside]]) for a, b in zip(old, new)]
        order = np.lexsort((both[4], both[3], both[2], -both[1], both[0]))
        both = [a[order] for a in both]
        place = np.arange(len(order)) - np.searchsorted(both[0], both[0])
        self.probe, self.score, self.no_id, self.vec_id, self.row_no = (a[place < self.keep] for a in both)
        full = place == self.keep - 1
        self.worst[both[0][full]] = both[1][full]


class _Block:
    """Anchors of a block and the rows found for them so far."""

    def __init__(self, batch: pa.Table, width: int, same_label: bool, keep: int):
        self.anchors, self.same_label = _Rows(batch, width), same_label
        given = batch["positive_scores"].combine_chunks()
        n = len(self.anchors)
        if same_label:
            self.first, self.n_probes = np.arange(n), np.ones(n, np.int64)
            low, high = np.full(n, -LARGEST), np.full(n, LARGEST)
        else:
            offsets = given.offsets.to_numpy()
            self.first, self.n_probes = offsets[:-1] - offsets[0], np.diff(offsets)
            p = np.asarray(given.values.to_numpy(zero_copy_only=False), np.int64)[offsets[0]:offsets[-1]]
            # 50 p <= 100 s <= 95 p in whole numbers, without products beyond a long.
            low, high = p - p // 2, 19 * (p // 20) + 19 * (p % 20) // 20
        self.kept = _Kept(low, high, keep)

    def limits(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score that any probe of the anchors a … b - 1 still takes."""
        low, high = np.full(b - a, float(LARGEST)), np.full(b - a, -float(LARGEST))
        for t in range(int(self.n_probes[a:b].max(initial=0))):
            has = np.flatnonzero(self.n_probes[a:b] > t)
            probe = self.first[a:b][has] + t
            wanted = self.kept.low[probe] <= self.kept.high[probe]
            low[has] = np.where(wanted, np.minimum(low[has], self.kept.worst[probe]), low[has])
            high[has] = np.where(wanted, np.maximum(high[has], self.kept.high[probe]), high[has])
        return low, high

    def add(self, rows: _Rows) -> None:
        exact = self.anchors.x.shape[1] * self.anchors.largest * rows.largest < EXACT
        for a in range(0, len(self.anchors), BATCH_ANCHORS):
            b = min(a + BATCH_ANCHORS, len(self.anchors))
            mask = self.anchors.label[a:b, None] == rows.label
            if self.same_label:
                mask &= self.anchors.row_no[a:b, None] != rows.row_no
            else:
                mask = ~mask
            low, high = self.limits(a, b)
            mask &= (low <= high)[:, None]
            i, j = open_pairs(self.anchors, rows, mask, low, high, a) if exact else np.nonzero(mask)
            i = i + a
            s = scores(self.anchors, rows, i, j)
            for t in range(int(self.n_probes[a:b].max(initial=0))):
                has = self.n_probes[i] > t
                at = j[has]
                self.kept.add(self.first[i[has]] + t, s[has], rows.no_id[at], rows.vec_id[at], rows.row_no[at])

    def found(self) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(self.anchors)), self.n_probes)[self.kept.probe]
        return pa.RecordBatch.from_arrays([
            pa.array(self.anchors.row_no[owner]), pa.array((self.kept.probe - self.first[owner]).astype(np.int32)),
            pa.array(self.kept.row_no), pa.array(self.kept.vec_id, mask=self.kept.no_id), pa.array(self.kept.score),
        ], ["anchor", "probe", "row_no", "vec_id", "score"])


def _search(batches: Iterator[pa.RecordBatch], width: int, same_label: bool, keep: int) -> Iterator[pa.RecordBatch]:
    """Batches are sorted: of every (block, share) first the anchors, then the rows."""
    key, anchors, block = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        names = np.stack([table[c].to_numpy() for c in ("block", "share", "side")])
        cuts = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1), table.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            part, at = table.slice(start, end - start), tuple(names[:2, start])
            if at != key:
                if block is not None:
                    yield block.found()
                key, anchors, block = at, [], None
            if names[2, start] == 0:
                anchors.append(part)
                continue
            if block is None and anchors:
                block = _Block(pa.concat_tables(anchors), width, same_label, keep)
            for k in range(0, part.num_rows if block is not None else 0, BATCH_ROWS):
                block.add(_Rows(part.slice(k, BATCH_ROWS), width))
    if block is not None:
        yield block.found()


def _best(rows: DataFrame, anchors: DataFrame, same_label: bool, keep: int) -> DataFrame:
    """The best ``keep`` rows of every probe of the anchors, with ``rank`` from 1."""
    size = rows.agg(F.max(F.size("v")).alias("width")).first()
    width, n_blocks = size.width or 0, max(1, -(-anchors.count() // BLOCK_ANCHORS))
    columns = ["row_no", "vec_id", "label", "v"]
    deal = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("row_no"), F.lit(SHARES)).cast("int").alias("share"), F.lit(1).alias("side"), *columns,
        F.lit(None).cast("array<bigint>").alias("positive_scores"))
    met = anchors.select(
        F.pmod(F.xxhash64("row_no"), F.lit(n_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"), F.lit(0).alias("side"), *columns, "positive_scores")
    ordered = deal.unionByName(met).repartition("block", "share").sortWithinPartitions("block", "share", "side")
    found = ordered.mapInArrow(lambda batches: _search(batches, width, same_label, keep), FOUND)
    # At most ``keep`` rows of each share.
    place = Window.partitionBy("anchor", "probe").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row_no")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= keep)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, scale: float = 256.0, n_positives: int = 5, n_negatives: int = 3
) -> DataFrame:
    """anchor_id, positive_id, ``rank`` (from 1), negative_id, positive_score, negative_score.

    ``vectors`` holds vec_id, label and embedding; components become floor of
    scale * x and a score is their inner product.  Positives of an anchor are
    the ``n_positives`` other rows of its label of highest score; negatives of
    an anchor and a positive the ``n_negatives`` highest rows of other labels
    scored from 50 to 95 percent of the positive.  Equal scores go by the
    smaller vec_id, a NULL vec_id last.  ``is_anchor`` and ``label`` are
    expressions of the columns of ``vectors``.

    Rows with a NULL label or vector, or a NULL or non-finite component take no
    part; rows equal in vec_id, label and vector count once.  Of vectors of
    unlike length the shorter one ends in zeros.  A component or score beyond a
    long becomes the largest or least long.  An empty table, an anchor without
    positives, a positive without negatives give no row.  Texts and other
    columns are not read.
    """
    rows = scaled_rows(vectors, scale, F.col("label") if label is None else label)
    anchors = rows.where(is_anchor)
    none = F.lit(None).cast("array<bigint>")
    positives = write_table(_best(rows, anchors.withColumn("positive_scores", none), True, n_positives), "positives")
    listed = positives.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))
    probed = anchors.join(listed, F.col("row_no") == F.col("anchor")).withColumn("positive_scores", F.col("p.score")).drop("p", "anchor")
    negatives = _best(rows, write_table(probed, "probed"), False, n_negatives)
    # Probe k of an anchor is its positive of rank k + 1.
    of = positives.select("anchor", (F.col("rank") - 1).alias("probe"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("row_no").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return negatives.join(of.join(names, "anchor"), ["anchor", "probe"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
