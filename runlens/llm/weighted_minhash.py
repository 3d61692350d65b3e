"""Near duplicates by improved consistent weighted sampling.

A text is the multiset of its five-word shingles, each weighted by its count times
its inverse document frequency.  Document frequencies of all texts are kept in
a table of fixed size, indexed by shingle hash, so it can be sent to every task
however large the corpus is; a shingle alone in its place has the highest
weight.  Consistent weighted samples agree between two texts with a
probability equal to their weighted Jaccard similarity; bands of samples bring
candidates together, and every link is verified by that similarity in full.

Equal texts are one node.  In each bucket all nodes are held against the one
that shares most buckets; whatever is then in different components of one bucket is
held against each other if the samples and the rarest shingles of both leave a similarity open.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.components import components
from runlens.llm.textblocks import Block, blocks, mix, within_text
from runlens.plans.tables import drop_table, write_table

SHINGLE = 5
THRESHOLD = 0.8
# At a similarity of 0.8 two texts share a bucket with probability 0.9998.
BANDS = 16
ROWS = 4
# Least share of equal samples of a pair worth verifying, 2.8 deviations below
# 0.8; and of the finer samples, 3 deviations.
ESTIMATE = 0.66
FINE_SAMPLES = 256
FINE_ESTIMATE = 0.725
# Share of a text's shingles, rare ones first, that are held against those of another before the whole
# texts are; two of similarity 0.8 differ in a ninth of their weight.
RARE = 0.25
# Places of the table of document frequencies.
PLACES = 1 << 17
# Distinct random variates of each sample.
VARIATES = 1 << 12


def text_shingles(block: Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of every distinct shingle, sorted by text.

    A text of fewer words, but at least one, has one shingle of all its words.
    """
    hashes, at = block.shingles(size)
    text = block.text_of_word[at]
    words = np.diff(block.first_word)
    short = np.flatnonzero((words > 0) & (words < size))
    if len(short):
        starts, ends = block.spans
        first, last = block.first_word[short], block.first_word[short + 1] - 1
        # Words may be set apart by other white space: hash them, not the bytes.
        h = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            more = first + k <= last
            h[more] = mix(h[more] + block.word_hash[first[more] + k])
        hashes, text = np.append(hashes, h), np.append(text, short)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(hashes)))


def place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - int(np.log2(PLACES)))).astype(np.int64)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Texts holding a shingle of each place, over all rows; ``PLACES`` numbers."""
    def run(batches):
        total = np.zeros(PLACES, np.int64)
        for batch in batches:
            for block in blocks(batch.column("text")):
                total += np.bincount(place(text_shingles(block)[1]), minlength=PLACES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["place", "n"])

    counts = texts.select("text").mapInArrow(run, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    table, out = counts.toArrow(), np.zeros(PLACES, np.int64)
    out[table["place"].to_numpy()] = table["n"].to_numpy()
    return out


def inverse_frequencies(counts: np.ndarray) -> np.ndarray:
    """Weight of one shingle by place: log of all shingles over those of the place."""
    return np.log1p(counts.sum() / np.maximum(counts, 1)).astype(np.float32)


@dataclass
class Sampler:
    """Improved consistent weighted sampling; variates come from tables indexed by hash."""

    n: int
    seed: int = 11

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        self.odd = rng.integers(0, 1 << 63, self.n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        shape = (self.n, VARIATES)
        self.r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
        self.c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)
        self.beta = rng.random(shape, np.float32)

    def samples(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row of ``n`` samples per set; ``starts`` are the first elements of the sets.

        For element x and weight S: t = floor(log S / r + beta), log a = c - r (t - beta + 1);
        the element of least a is the sample, known by a and its hash.
        """
        log_s = np.log(weights).astype(np.float32)
        out = np.empty((len(starts), self.n), np.uint64)
        for k in range(self.n):
            own = hashes * self.odd[k]
            at = (own >> np.uint64(52)).astype(np.int64)
            r, beta = self.r[k].take(at), self.beta[k].take(at)
            low = self.c[k].take(at) - r * (np.floor(log_s / r + beta) - beta + 1)
            bits = low.view(np.uint32)
            order = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
            out[:, k] = np.minimum.reduceat((order << np.uint64(32)) | (mix(own) >> np.uint64(32)), starts)
        return out


_samplers: dict[int, Sampler] = {}


def _sampler(n: int) -> Sampler:
    if n not in _samplers:
        _samplers[n] = Sampler(n)
    return _samplers[n]


def sketches(texts: DataFrame, idf, n: int = BANDS * ROWS) -> DataFrame:
    """``node`` and ``sketch`` (``n`` samples) of every text (node, text) with a word; ``idf`` is a broadcast variable."""
    def run(batches):
        sampler = _sampler(n)
        for batch in batches:
            for block in blocks(batch.column("text")):
                text, hashes, counts = text_shingles(block)
                if not len(text):
                    continue
                starts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                found = sampler.samples(hashes, counts * idf.value[place(hashes)], starts)
                values = pa.array(found.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1, dtype=np.int32) * found.shape[1]), values)
                nodes = batch.column("node").slice(block.first_row, block.n_texts).take(pa.array(text[starts]))
                yield pa.RecordBatch.from_arrays([nodes, lists], ["node", "sketch"])

    return texts.select("node", "text").mapInArrow(run, "node binary, sketch array<bigint>")


def similarities(pairs: DataFrame, idf) -> DataFrame:
    """``a``, ``b`` and weighted Jaccard ``similarity`` of pairs with their texts (a, b, text_a, text_b)."""
    def weighted(texts, idf_values):
        """Element keys by row, their weights and the total of each row."""
        keys, weights, rows = [], [], []
        for block in blocks(texts):
            text, hashes, counts = text_shingles(block)
            rows.append(text + block.first_row)
            keys.append(hashes)
            weights.append((counts * idf_values[place(hashes)]).astype(float))
        rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
        weights = np.concatenate(weights) if weights else np.empty(0)
        return within_text(np.concatenate(keys), rows) if keys else np.empty(0, np.uint64), weights, rows

    def run(batches):
        for batch in batches:
            # Few rows at a time: the pairs of a popular text repeat it.
            size = np.cumsum([len(a) + len(b) for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())])
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(size // (4 << 20))) + 1):
                if not len(part):
                    continue
                rows = batch.slice(int(part[0]), len(part))
                ka, wa, ra = weighted(rows.column("text_a"), idf.value)
                kb, wb, rb = weighted(rows.column("text_b"), idf.value)
                _, ia, ib = np.intersect1d(ka, kb, return_indices=True)
                common = np.bincount(ra[ia], weights=np.minimum(wa[ia], wb[ib]), minlength=len(part))
                total = np.bincount(ra, weights=wa, minlength=len(part)) + np.bincount(rb, weights=wb, minlength=len(part))
                yield pa.RecordBatch.from_arrays([rows.column("a"), rows.column("b"), pa.array(common / np.maximum(total - common, 1e-9))],
                                                 ["a", "b", "similarity"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary, similarity double")


def text_node(text: Column) -> Column:
    """The same 16 bytes for equal texts."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _agreement(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def element_weights(texts: DataFrame, idf) -> DataFrame:
    """``node``, ``element`` and ``weight`` of every shingle of every text (node, text); no shuffle.

    A shingle met again in a text is another element, so an element weighs the same in all texts.
    """
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column("text")):
                text, hashes, counts = text_shingles(block)
                again = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
                text, hashes = np.repeat(text, counts), np.repeat(hashes, counts)
                nodes = batch.column("node").slice(block.first_row, block.n_texts).take(pa.array(text))
                elements = np.where(again > 0, within_text(hashes, again), hashes).view(np.int64)
                yield pa.RecordBatch.from_arrays([nodes, pa.array(elements), pa.array(idf.value[place(hashes)].astype(float))],
                                                 ["node", "element", "weight"])

    return texts.select("node", "text").mapInArrow(run, "node binary, element bigint, weight double")


def rarest_elements(elements: DataFrame) -> DataFrame:
    """``node``, the ``total`` weight of its elements, the ``rare`` ones (a share ``RARE``) that fewest nodes have, and the ``least`` weight of these.

    A rare element is the number of its nodes, then bits of its hash; two with equal bits count as one, which never hides what is shared.
    """
    rarity = elements.groupBy("element").agg(F.count(F.lit(1)).alias("n"))
    rank = F.shiftleft(F.least("n", F.lit((1 << 23) - 1)), 40) + F.col("element").bitwiseAND((1 << 40) - 1)
    ranked = elements.join(rarity, "element").select("node", rank.alias("rank"), "weight")
    by_node = Window.partitionBy("node")
    ranked = ranked.select("node", "rank", "weight", F.sum("weight").over(by_node).alias("total"), F.count(F.lit(1)).over(by_node).alias("size"), F.row_number().over(by_node.orderBy("rank")).alias("at"))
    return ranked.where(F.col("at") <= F.ceil(F.col("size") * RARE)).groupBy("node").agg(
        F.first("total").alias("total"), F.min("weight").alias("least"), F.sort_array(F.collect_list("rank")).alias("rare"))


def shared_at_most(a: str, b: str) -> Column:
    """Weight that ``b`` can have in common with ``a``: all but the rare elements of ``a`` that ``b`` surely lacks.

    An element that stands before the last of ``b``'s rare ones in the order of all is in ``b`` only if it is one of them.
    """
    lacking = F.filter(F.array_except(f"{a}.rare", f"{b}.rare"), lambda e: e < F.element_at(f"{b}.rare", -1))
    return F.col(f"{a}.total") - F.size(lacking) * F.col(f"{a}.least")


def near_links(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified links (a, b, similarity) between nodes: those that join components.

    Two texts as similar as ``threshold`` are in one component of the links; pairs
    within a component found by other links are not verified again.
    """
    texts = docs.select(text_node(F.col("text")).alias("node"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    idf = docs.sparkSession.sparkContext.broadcast(inverse_frequencies(document_frequencies(texts)))
    known = write_table(sketches(texts, idf).dropDuplicates(["node"]), "sketches")
    # A bucket is a band and a hash of its samples, in one number.
    keys = F.array(*[F.xxhash64(F.lit(k), F.slice("sketch", k * ROWS + 1, ROWS)) for k in range(BANDS)])
    rows = known.select("node", F.posexplode(keys).alias("band", "key"))
    sizes = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    members = write_table(rows.join(sizes, ["band", "key"]), "buckets")
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "node")
    pivots = ranked.groupBy("band", "key").agg(F.max(F.struct("degree", "node"))["node"].alias("pivot"))
    stars = (members.join(pivots, ["band", "key"]).where(F.col("node") != F.col("pivot"))
             .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
    candidates = members.select("node").distinct()
    wanted = write_table(texts.join(candidates, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        left = wanted.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = wanted.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return similarities(pairs.join(left, "a").join(right, "b"), idf).where(F.col("similarity") >= threshold)

    first = write_table(verified(stars), "links")
    # The rest: nodes of one bucket in different components.
    parts = components(first)
    open_rows = members.join(parts, "node", "left").select(
        "band", "key", "node", F.coalesce("component", "node").alias("component"))
    unsettled = (open_rows.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
                 .where((F.col("low") != F.col("high")) & (F.col("n") > 2)).select("band", "key"))
    open_parts = write_table(open_rows.join(unsettled, ["band", "key"]), "rest")
    fine = sketches(wanted.join(open_parts.select("node").distinct(), "node", "left_semi"), idf, FINE_SAMPLES)
    elements = write_table(element_weights(wanted.join(open_parts.select("node").distinct(), "node", "left_semi"), idf), "elements")
    rest = write_table(open_parts.join(rarest_elements(elements), "node").join(known.withColumn("keys", keys), "node").join(fine.withColumnRenamed("sketch", "fine"), "node"), "rest")
    x, y = rest.alias("x"), rest.alias("y")
    agree = _agreement(F.col("x.sketch"), F.col("y.sketch"))
    agree_fine = _agreement(F.col("x.fine"), F.col("y.fine"))
    # What two texts as similar as the threshold share at least; sums of doubles differ in their last bits.
    least = threshold / (1 + threshold) * (F.col("x.total") + F.col("y.total")) * (1 - 1e-6)
    may_link = (shared_at_most("x", "y") >= least) & (shared_at_most("y", "x") >= least)
    # A pair that shares several buckets is made in the first of them only.
    first_shared = F.array_position(F.zip_with("x.keys", "y.keys", lambda p, q: p == q), True) - 1
    pairs = (x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
                    & (F.col("x.component") != F.col("y.component")) & (first_shared == F.col("x.band")) & (agree >= ESTIMATE * BANDS * ROWS) & (agree_fine >= FINE_ESTIMATE * FINE_SAMPLES) & may_link)
             .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    second = verified(pairs.join(stars, ["a", "b"], "left_anti"))
    links = write_table(first.unionByName(second), "links")
    for table in (known, members, wanted, first, parts, open_parts, elements, rest):
        drop_table(table)
    return links


def duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``node``, ``class_id``, ``n_texts`` and ``keeper`` of every row of ``docs``.

    ``keeper`` (doc_id, node) names the document of the class with the smallest doc_id.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_node(F.col("text")).alias("node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    nodes = rows.groupBy("node").agg(first.alias("first"))
    parts = components(near_links(docs, threshold))
    nodes = nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = nodes.groupBy("component").agg(F.min("first").alias("keeper"), F.count(F.lit(1)).alias("n_texts"))
    by_node = nodes.join(classes, "component").select("node", "keeper", "n_texts")
    return rows.join(by_node, "node").select("doc_id", "node", F.col("keeper.doc_id").alias("class_id"), "n_texts",
                                             F.struct("keeper.doc_id", "keeper.node").alias("keeper"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``class_id`` and ``n_texts``.

    ``class_id`` is the smallest doc_id among the texts linked, directly or in
    steps, at ``threshold``; ``n_texts`` counts the distinct texts of the class.  A
    NULL text counts as empty; empty texts are one class, texts without
    a word are equal to their own copies only.  A class of rows with no doc_id at all
    has a NULL class_id.  Other columns are ignored; an empty table gives no row.
    """
    return duplicate_classes(docs, threshold).select("doc_id", "class_id", "n_texts")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one of smallest doc_id; repeated rows of it become one.

    Other columns may have any name.
    """
    keepers = duplicate_classes(docs, threshold).select(F.col("keeper.doc_id").alias("_id"), F.col("keeper.node").alias("_node")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("_doc"), "doc_id", text_node(F.col("text")).alias("_own"))
    kept = rows.join(keepers, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_node")))
    return kept.dropDuplicates(["doc_id", "_own"]).select("_doc.*")
