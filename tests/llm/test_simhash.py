"""Components against brute force over all pairs; the edges of the grid join; awkward rows."""

import random
import re

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from storeops.llm import graph, simhash

SF = "/root/testdata/sf0.001"


def slow_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def slow_components(prints):
    """Smallest id reachable, for (id, fingerprint) rows."""
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, p) in enumerate(prints):
        for j, q in prints[:n]:
            if (p ^ q).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in prints}


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def test_query_against_brute_force(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    prints = [(i, slow_print(t)) for i, t in texts]
    roots = slow_components(prints)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.op6_simhash(spark, SF).collect()}
    assert got == {(i, f"{p:016x}", roots[i]) for i, p in prints}


@pytest.mark.parametrize("crowded", [64, 1])
def test_links_near_and_far(spark, monkeypatch, crowded):
    """Chains and clouds of fingerprints; with a bound of 1 every shared cell is refined."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(crowded)
    prints = [0, 1, 3, 2**64 - 1, 2**63]
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(8):
            prints.append(centre)
            for _ in range(rng.randint(0, 3)):
                centre ^= 1 << rng.randrange(64)
    rows = list(enumerate(prints))
    frame = spark.createDataFrame([(i, signed(p)) for i, p in rows], "doc_id long, fp long")
    ids = {r.fp: r.component_id for r in simhash.component_ids(frame).collect()}
    roots = slow_components(rows)
    assert {i: ids[signed(p)] for i, p in rows} == roots


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(4).shuffle(order)
    edges = list(zip(order, order[1:])) + [(300, 301), (301, 300), (5, 5), (None, 7)]
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(200)} | {(300, 300), (301, 300)}


def test_a_long_text_is_voted_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 911}" for i in range(500))
    whole = simhash.fingerprint_of(text.encode())
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint_of(text.encode()) == whole
    assert whole & (2**64 - 1) == slow_print(text)


def test_awkward_rows(awkward, clash, empty):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == 7
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.fingerprint, r.component_id))
    assert by_id[2] == by_id[3] == by_id[4] == [("0" * 16, 2)]
    assert len(by_id[1]) == 2 and by_id[None][0] == by_id[1][0] and by_id[1][0][1] == 1
    assert sorted(map(str, simhash.near_duplicates(clash).collect())) == sorted(map(str, rows))
    assert simhash.near_duplicates(empty).count() == 0


def test_one_row_of_each_component_stays(awkward, clash, empty, docs_of):
    assert sorted(r.doc_id for r in simhash.keep_first(awkward).collect()) == [1, 2, 7]
    kept = simhash.keep_first(clash)
    assert kept.columns == clash.columns and kept.filter(F.col("fp") == "x-fp").count() == 3
    assert simhash.keep_first(empty).count() == 0
    nameless = docs_of("same words here", "same words here", ids=[None, None])
    assert simhash.keep_first(nameless).count() == 1
