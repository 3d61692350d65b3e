"""The prefix trie against brute force, in one shard and in many."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EXTRA = ["own", "path", "end", "item", "shard", "seq", "n", "ends", "fragment"]
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        gain = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += gain
    return sorted(((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()) for node, m in members.items()), key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in pt.prefix_trie(df).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in EXTRA})


def conversations(n, seed, words=3, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        same_start = rng.random() < 0.4
        for k in range(rng.randint(0, longest)):
            text = "hello" if k == 0 and same_start else "é" * rng.randint(1, words)
            rows.append((c, k, rng.choice(["user", "bot"]) if k else "user", text))
    copies = [(1000 + k, t, r, x) for k in range(200) for c, t, r, x in rows if c == 5]
    rows += copies
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("paths", [4, 30, 8_192])
def test_against_brute_force(spark, paths, monkeypatch):
    monkeypatch.setattr(pt, "SHARD_PATHS", paths)
    rows = conversations(230, 3)
    want = brute(rows)
    assert any(r[3] > 200 for r in want) and found(table(spark, rows)) == want


def test_members_met_through_salts(spark, join_way, monkeypatch):
    monkeypatch.setattr(pt, "SHARD_PATHS", 20)
    rows = conversations(120, 8, words=2)
    assert found(table(spark, rows)) == brute(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(pt, "SHARD_PATHS", 2)
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, None, "a"),
            (-5, 0, "user", "x"), (-100, 0, "user", "x"), (-105, 1, "user", "y"), (None, 0, "user", "lost"), (200, 3, "user", "ü" * 50_000),
            (207, 0, "user", "short"), (301, 0, "user", "only one turn"), (302, 0, "user", "only one turn")]
    rows += [(400, k, "user", str(k)) for k in range(2000)] + [(401, k, "user", str(k)) for k in range(1500)]
    assert found(table(spark, rows)) == brute(rows)


def test_empty_and_turnless(spark):
    assert found(table(spark, [])) == [] and found(table(spark, [(None, 0, "user", "a")])) == []
    turnless = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(turnless, 0, "user", "a")]
    assert found(table(spark, rows)) == brute(rows) and len(brute(rows)) == 1


@pytest.mark.parametrize("n", [1, 2, 3, 40, 700, 5000])
def test_findclose(n):
    rng = random.Random(n)
    bits, depth = [1], 1
    while len(bits) < n or depth > 1:
        up = len(bits) < n and (depth == 1 or rng.random() < 0.5)
        bits.append(int(up))
        depth += 1 if up else -1
    bits.append(0)
    stack, want = [], {}
    for k, b in enumerate(bits):
        if b:
            stack.append(k)
        else:
            want[stack.pop()] = k
    bp = pt.Parentheses(np.array(bits))
    assert bp.findclose(bp.opens).tolist() == [want[k] for k in bp.opens.tolist()]
    pairs = [k for k in range(len(bits) - 1) if bits[k] and not bits[k + 1]]
    assert all(bp.pairs_before[want[k]] - bp.pairs_before[k] == sum(k <= p < want[k] for p in pairs) for k in bp.opens.tolist()[:50])


def test_range_minimum():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, 300)
    first = rng.integers(0, 300, 500)
    count = np.array([rng.integers(1, 301 - f) for f in first])
    assert pt.range_minimum(values, first, count).tolist() == [values[f:f + c].min() for f, c in zip(first, count)]


def test_member_digests_in_pieces(spark):
    paths = spark.range(150_000).select(F.col("id").alias("conv_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("end"))
    got = {r.end: r.ends for r in pt.member_digests(paths).where("end in ('hot', '0', '149997')").collect()}
    hot = ",".join(str(i) for i in range(150_000) if i % 3)
    assert got == {"hot": hashlib.sha256(hot.encode()).hexdigest(), "0": hashlib.sha256(b"0").hexdigest(), "149997": hashlib.sha256(b"149997").hexdigest()}
