"""The prefix trie against tuples of turns, its sketch, and awkward conversations."""

import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import sha
from storeops.llm import trie as t

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def slow_trie(rows):
    """All nodes as {(depth, conv_id): the other columns}, the parent's first."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((turn is not None, turn or 0, role, np.array(xxhash.xxh64_intdigest(text, 42), np.uint64).view(np.int64)), role, text))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    out = {}
    for key, cs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        children = [k for k in below if len(k) == len(key) + 1]
        leaves = sum(1 for k in below if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in below))
        saved = sum((len(members[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) for k in below if k)
        ends = sha(",".join(str(c) for c in cs if len(built[c]) == len(key)))
        parent = members[key[:-1]][0] if key else None
        out[len(key), cs[0]] = (parent, len(cs), len(children), leaves, saved, ends)
    return out


def fast_trie(spark, rows):
    frame = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    turns, convs = t.lent(t.numbered(frame))
    got = t.trie(turns, convs).collect()
    out = {(r.depth, r.conv_id): tuple(r)[2:] for r in got}
    assert len(out) == len(got)
    return out


def many(seed, size=60):
    """Conversations of few words, so that most beginnings are shared; gaps, null and equal turns, null roles and texts."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(200), size):
        for k in range(rng.choice([0, 1, 2, 3, 5, 9])):
            turn = rng.choice([k, k, k, None, 3])
            rows.append((c, turn, rng.choice(["user", "bot", None, ""]), rng.choice(["a", "a b", None, "", "x\ty z"])))
    return rows + rng.sample(rows, 5)


@pytest.mark.parametrize("seed", [1, 2])
def test_small_alphabets(spark, seed):
    rows = many(seed)
    assert fast_trie(spark, rows) == slow_trie(rows)


def test_given_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    got = {(r.depth, r.conv_id): tuple(r)[2:] for r in t.op11_trie(spark, SF).collect()}
    assert got == slow_trie(rows)


def test_blocks_chunks_and_a_crowded_sketch(spark, monkeypatch):
    """Short blocks and chunks, and a sketch so small that it proves next to nothing."""
    monkeypatch.setattr(t, "BLOCK", 2)
    monkeypatch.setattr(t, "CHUNK_BITS", 1)
    monkeypatch.setattr(t, "LEAST_BITS", 1)
    monkeypatch.setattr(t, "MOST_BITS", 2)
    rows = many(3, 40) + [(c, k, "user", f"w{k}") for c in range(1000, 1030) for k in range(6)]
    assert fast_trie(spark, rows) == slow_trie(rows)


def test_a_long_conversation_and_its_copy(spark):
    rows = [(c, k, "user", f"turn {k}") for c in (1, 2) for k in range(300)]
    assert fast_trie(spark, rows) == slow_trie(rows)


def test_awkward_tables(spark):
    assert fast_trie(spark, [(None, 1, "user", "a")]) == {}
    assert t.trie(*t.lent(t.numbered(spark.createDataFrame([], SCHEMA)))).count() == 0
    lone = next(c for c in range(21, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    got = fast_trie(spark, [(lone, 0, None, None)])  # its only turn goes, nobody lends one
    assert got == {(0, lone): (None, 1, 0, 1, 0, sha(str(lone)))}
    long = "w " * 200_000
    rows = [(0, 0, "user", long), (20, 0, "user", long)]
    assert fast_trie(spark, rows) == slow_trie(rows)
    clash = spark.createDataFrame(many(5), SCHEMA).select("*", *[F.lit("x").alias(n) for n in ("a", "b", "pos", "depth", "size", "words", "shared", "part")])
    assert fast_trie(spark, clash) == slow_trie(many(5))


def test_the_sketch_never_counts_too_low(spark):
    rng = np.random.default_rng(0)
    a, b = (rng.integers(-(2**63), 2**63, 3000) for _ in "ab")
    a[1000:2000], b[1000:2000] = a[:1000], b[:1000]
    found = spark.createDataFrame(list(zip(map(int, a), map(int, b))), "a long, b long")
    crowded, bits = t.crowded_cells(found)
    mask = (1 << bits) - 1
    many_ = [crowded[c >> 3] >> (c & 7).astype(np.uint8) & 1 for c in (a & mask, (b & mask) + mask + 1)]
    assert (many_[0] & many_[1])[:2000].all() and (many_[0] & many_[1])[2000:].mean() < 0.1
