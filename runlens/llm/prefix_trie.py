"""Prefix trie of conversations as balanced parentheses.

A conversation is a path of turns, each known by a digest of role and text, so
texts never move.  Equal paths are merged first.  The distinct paths are put in
order and cut into shards of bounded size; a shard's paths in order are a walk
through its part of the trie, written as parentheses: one opens where a node is
entered and closes where it is left.  Blocks of the running excess (opened less
closed) with their least and largest value answer ``findclose``, which delimits
a node's subtree; ranks of the pairs "()" count its leaves, and differences of
running sums give its members and savings.

The nodes on the path where two shards meet are in both.  Each shard knows how
many (the common prefix with its neighbours' paths), counts such a node's own
weight in the first shard only, and returns partial sums for it; these few rows
are merged by a grouped sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.plans.tables import fits_broadcast, lookup_join, write_table

# Conversations of one base, and most turns taken from it.
BASE_STEP = 100
HEAD_TURNS = 5
# Distinct paths of a shard, about; parentheses of an excess block; ids of one piece of text.
SHARD_PATHS = 8_192
EXCESS_BLOCK = 64
PIECE_IDS = 65_536

NODES = ("depth bigint, key string, parent_key string, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,"
         " n_leaves bigint, saved_tokens bigint, ends string, fragment boolean")


# ---- paths -------------------------------------------------------------------

def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id and ``own``, its turns in order as (item, chars), stored.

    Order is by turn, NULL first, then by role and by the digest of the text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), F.sha2(text, 256).alias("digest"), F.length(text).alias("chars"))
    # 128 bits tell turns apart.
    item = F.substring(F.sha2(F.concat(F.sha2("role", 256), F.col("digest")), 256), 1, 32)
    entry = F.struct(F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"),
                     "role", "digest", item.alias("item"), "chars")
    listed = rows.select("conv_id", entry.alias("e")).groupBy("conv_id").agg(F.array_sort(F.collect_list("e")).alias("all"))
    own = F.transform("all", lambda e: F.struct(e["item"].alias("item"), e["chars"].alias("chars")))
    return write_table(listed.select("conv_id", own.alias("own")), "conversations")


def head_length(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEAD_TURNS + 1)).cast("int")


def rebuilt_paths(own: DataFrame) -> DataFrame:
    """conv_id, ``path`` and ``end`` (its digest): the first turns of the base conversation, then the own turns behind them."""
    heads = own.where(F.col("conv_id") % BASE_STEP == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, HEAD_TURNS).alias("head"))
    # A base has at most as many conversations as the step, so no key of this join is large.
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE_STEP).join(heads, "base", "left")
    h = head_length(F.col("conv_id"))
    none = F.array().cast(own.schema["own"].dataType)
    path = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("own", h + 1, F.greatest(F.size("own"), F.lit(1))))
    return joined.select("conv_id", path.alias("path")).withColumn(
        "end", F.sha2(F.array_join(F.transform("path", lambda e: e["item"]), ""), 256))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (end, conv_id) rows to pieces of joined ids: end, first id, text."""
    end, ids = None, []

    def piece():
        return pa.RecordBatch.from_arrays([pa.array([end]), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                                          ["end", "first_id", "ids"])
    for batch in batches:
        out = []
        for e, i in zip(batch["end"].to_pylist(), batch["conv_id"].to_pylist()):
            if ids and (e != end or len(ids) == PIECE_IDS):
                out.append(piece())
                ids = []
            end = e
            ids.append(i)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest per end; only the state of the digest is held."""
    names, values, end, state = [], [], None, None
    for batch in batches:
        for e, text in zip(batch["end"].to_pylist(), batch["ids"].to_pylist()):
            if e != end:
                if state is not None:
                    names.append(end), values.append(state.hexdigest())
                end, state = e, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(values)], ["end", "ends"])
            names, values = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([end]), pa.array([state.hexdigest()])], ["end", "ends"])


def member_digests(paths: DataFrame) -> DataFrame:
    """``end`` and ``ends``: SHA-256 of the ids of all conversations of that path, ascending, joined by commas.

    The joined text is made in pieces by many tasks; the digest of one path reads its pieces in order.
    """
    ordered = paths.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    pieces = ordered.mapInArrow(_pieces, "end string, first_id bigint, ids string")
    return pieces.repartition("end").sortWithinPartitions("end", "first_id").mapInArrow(_digests, "end string, ends string")


# ---- balanced parentheses ----------------------------------------------------

class Parentheses:
    """Balanced parentheses with blocks of least and largest excess under a binary tree."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(np.int64)
        self.opens = np.flatnonzero(self.bits)
        self.excess = np.cumsum(2 * self.bits - 1)
        n_blocks = max(1, -(-len(bits) // EXCESS_BLOCK))
        self.leaves = 1 << (n_blocks - 1).bit_length()
        padded = np.full(self.leaves * EXCESS_BLOCK, np.iinfo(np.int64).max // 2)
        padded[:len(bits)] = self.excess
        self.padded = padded
        blocks = padded.reshape(-1, EXCESS_BLOCK)
        # Node 1 is the root; node k has the children 2 k and 2 k + 1.
        self.least = np.empty(2 * self.leaves, np.int64)
        self.largest = np.empty(2 * self.leaves, np.int64)
        self.least[self.leaves:], self.largest[self.leaves:] = blocks.min(axis=1), blocks.max(axis=1)
        low = self.leaves
        while low > 1:
            low //= 2
            pairs = slice(2 * low, 4 * low)
            self.least[low:2 * low] = self.least[pairs].reshape(-1, 2).min(axis=1)
            self.largest[low:2 * low] = self.largest[pairs].reshape(-1, 2).max(axis=1)
        # Pairs "()" before each place.
        pair = np.zeros(len(bits) + 1, np.int64)
        pair[1:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.pairs_before = np.cumsum(pair)

    def _holds(self, node: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        return (self.least[node] <= wanted) & (wanted <= self.largest[node])

    def _first_in_block(self, block: np.ndarray, after: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """First place of ``block`` behind ``after`` with the wanted excess, -1 if there is none."""
        found = np.full(len(block), -1)
        for k in range(EXCESS_BLOCK):
            place = block * EXCESS_BLOCK + k
            hit = (found < 0) & (place > after) & (self.padded[place] == wanted)
            found[hit] = place[hit]
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The closing place of each opening one: the next place of an excess lower by one."""
        wanted = self.excess[opens] - 1
        found = self._first_in_block(opens // EXCESS_BLOCK, opens, wanted)
        rest = np.flatnonzero(found < 0)
        node, want = opens[rest] // EXCESS_BLOCK + self.leaves, wanted[rest]
        climbing = np.ones(len(rest), bool)
        while climbing.any():
            # Excess moves in steps of one, so a node holds every value between its ends.
            beside = climbing & (node % 2 == 0)
            beside[beside] = self._holds(node[beside] + 1, want[beside])
            node = np.where(beside, node + 1, np.where(climbing, node // 2, node))
            climbing &= ~beside
        while (inner := node < self.leaves).any():
            left = 2 * node[inner]
            node[inner] = np.where(self._holds(left, want[inner]), left, left + 1)
        block = node - self.leaves
        found[rest] = self._first_in_block(block, np.full(len(rest), -1), want)
        return found


def range_minimum(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Least of values[first : first + count], by tables over powers of two."""
    out = np.empty(len(first), values.dtype)
    power = np.floor(np.log2(count)).astype(int)
    level, table = 0, values
    while True:
        at = np.flatnonzero(power == level)
        out[at] = np.minimum(table[first[at]], table[first[at] + count[at] - (1 << level)])
        if level == power.max():
            return out
        table = np.minimum(table[:-(1 << level)], table[1 << level:])
        level += 1


def _key(items: list[str]) -> str:
    return hashlib.sha256("".join(items).encode()).hexdigest()


def shard_nodes(shard: pa.Table) -> pa.Table:
    """Nodes of one shard; ``left`` and ``right`` are the depths shared with the neighbours' paths, -1 without one."""
    shard = shard.sort_by("seq")
    paths, chars = shard["items"].to_pylist(), shard["chars"].to_pylist()
    left, right = shard["left"][0].as_py(), shard["right"][0].as_py()
    bits, depth, parent, weight, end_node = [1], [0], [-1], [0], []
    stack, previous = [0], []
    for path, lengths in zip(paths, chars):
        common = 0
        while common < len(previous) and common < len(path) and previous[common] == path[common]:
            common += 1
        bits += [0] * (len(previous) - common)
        del stack[common + 1:]
        for d in range(common, len(path)):
            parent.append(stack[-1])
            stack.append(len(depth))
            depth.append(d + 1)
            weight.append(lengths[d])
            bits.append(1)
        end_node.append(stack[-1])
        previous = path
    bits += [0] * (len(previous) + 1)
    n = len(depth)
    depth, parent, weight, end_node = (np.array(x, np.int64) for x in (depth, parent, weight, end_node))

    bp = Parentheses(np.array(bits))
    close = bp.findclose(bp.opens)
    count = (close - bp.opens + 1) // 2  # nodes of the subtree, which are numbered on end
    first = np.arange(n)

    def in_subtree(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[first + count] - sums[first]

    # The first nodes are those of the first path, the stack those of the last.
    owned = first > left
    fragment = ~owned
    fragment[stack[:right + 1]] = True
    members = np.zeros(n, np.int64)
    members[end_node] = shard["n"].to_numpy()
    ids = np.full(n, np.iinfo(np.int64).max)
    ids[end_node] = shard["first_conv"].to_numpy()
    n_convs = in_subtree(members)
    # Turns of all members, less one turn of each node.
    saved = in_subtree(n_convs * weight) - in_subtree(np.where(owned, weight, 0))
    n_leaves = bp.pairs_before[close] - bp.pairs_before[bp.opens]
    if right == len(previous):
        n_leaves[stack] -= 1  # the last path goes on in the next shard
    own_parent = parent[1:][owned[1:]]
    conv_id = range_minimum(ids, first, count)
    keys = [None] * n
    for d in range(left + 1):
        keys[d] = _key(paths[0][:d])
    for d in range(right + 1):
        keys[stack[d]] = _key(paths[-1][:d])
    above = np.maximum(parent, 0)
    whole_parent = (parent >= 0) & ~fragment[above]
    ends = [None] * n
    for node, value in zip(end_node.tolist(), shard["ends"].to_pylist()):
        ends[node] = value
    return pa.table({
        "depth": depth, "key": pa.array(keys, pa.string()),
        "parent_key": pa.array([keys[p] if p >= 0 else None for p in parent.tolist()], pa.string()),
        "conv_id": conv_id, "parent_conv_id": pa.array(conv_id[above], mask=~whole_parent),
        "n_convs": n_convs, "n_children": np.bincount(own_parent, minlength=n), "n_leaves": n_leaves,
        "saved_tokens": saved, "ends": pa.array(ends, pa.string()), "fragment": fragment})


def _common(a: Column, b: Column) -> Column:
    """Length of the common prefix of two unlike arrays, -1 if one is NULL."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False) - 1
    return F.coalesce(differ, F.lit(-1)).cast("int")


def shards(paths: DataFrame) -> DataFrame:
    """Distinct paths in order, cut into shards, with what each shares with its neighbours."""
    merged = paths.groupBy("path", "end").agg(F.min("conv_id").alias("first_conv"), F.count(F.lit(1)).alias("n"))
    merged = write_table(merged.join(member_digests(paths), "end"), "paths")
    n_shards = max(1, -(-merged.count() // SHARD_PATHS))
    lists = merged.select(F.transform("path", lambda e: e["item"]).alias("items"), F.transform("path", lambda e: e["chars"]).alias("chars"),
                          "first_conv", "n", "ends")
    ordered = lists.repartitionByRange(n_shards, "items").sortWithinPartitions("items")
    ordered = write_table(ordered.withColumns({"shard": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}), "shards")
    edges = ordered.groupBy("shard").agg(F.min_by("items", "seq").alias("first"), F.max_by("items", "seq").alias("last"))
    row = Window.orderBy("shard")  # one row a shard
    edges = write_table(edges.select(
        "shard", _common(F.lag("last").over(row), F.col("first")).alias("left"),
        _common(F.col("last"), F.lead("first").over(row)).alias("right")), "edges")
    return lookup_join(ordered, edges, ["shard"], broadcast=fits_broadcast(edges))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    ``turns``: conv_id, turn, role, text; other columns are not read, whatever
    their names.  A NULL role or text is empty, a NULL turn comes first; turns
    of one number go by role, then by the SHA-256 of the text; a repeated row is
    a turn of its own.  Rows without conv_id take no part.  Texts may have any
    length, as only their digest and length are kept; the digests of one
    conversation (32 bytes a turn) fit a row.  Turns are equal if 128 bits of
    their digest are.  A conversation may be rebuilt to no turn, it is then a
    member of the root only; an empty table has no root and gives no row.
    """
    paths = write_table(rebuilt_paths(ordered_turns(turns)), "rebuilt")
    nodes = write_table(shards(paths).groupBy("shard").applyInArrow(shard_nodes, NODES), "nodes")
    # Pieces of the nodes where shards meet: at most a path for each shard's end.
    merged = write_table(nodes.where("fragment").groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends").alias("ends")), "merged")
    small = fits_broadcast(merged)
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    whole = lookup_join(nodes.where(~F.col("fragment")), above, ["parent_key"], "left", broadcast=small)
    parts = lookup_join(merged.withColumn("parent_conv_id", F.lit(None).cast("bigint")), above, ["parent_key"], "left", broadcast=small)
    every = whole.select("above", "ends", *columns).unionByName(parts.select("above", "ends", *columns))
    return every.withColumn("parent_conv_id", F.coalesce("above", "parent_conv_id")).select(
        *columns, F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
