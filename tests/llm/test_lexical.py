"""Ranked search against scoring every document, the sparse tables against plain maxima, and awkward tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeops.llm import lexical as x

ITEMS = "item_id long, text string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def slow_rank(docs, items, top=x.TOP):
    """{(item_id, rank): (doc_id, score)} for (id, text) rows with unique item ids."""
    bags = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(w for _, bag, _ in bags for w in bag)
    out = {}
    for item, text in items:
        scores = []
        for i, bag, n in bags:
            m = 25 + (75 * n * n_docs) // total
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * bag[w]) // (1000 * bag[w] + 8 * m))
                for w, r in Counter(words(text)).items()
                if w in bag
            )
            scores.append((-score, i is None, i))
        for k, (score, _, i) in enumerate(sorted(s for s in scores if s[0] < 0)[:top], 1):
            out[item, k] = (i, -score)
    return out


def fast_rank(docs, items, **how):
    got = x.rank(docs, items, **how).collect()
    out = {(r.item_id, r.rank): (r.doc_id, r.score) for r in got}
    assert len(out) == len(got)
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{int(abs(rng.gauss(0, 40)))}" for _ in range(2000)] + ["Éa", "2x"]
    docs = [(i * 7 % n, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(30)]  # copies tie
    items = [(i, "; ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12, 40])))) for i in range(15)]
    return docs, items + [(98, docs[5][1]), (99, "unseen terms only")]


@pytest.mark.parametrize("shard, batch", [(8192, 128), (50, 1), (7, 3)])
def test_every_document_scored(spark, docs_of, monkeypatch, shard, batch):
    monkeypatch.setattr(x, "SHARD_DOCS", shard)
    monkeypatch.setattr(x, "BATCH", batch)
    docs, items = corpus(shard)
    frame = docs_of(*[t for _, t in docs], ids=[i for i, _ in docs])
    want = slow_rank(docs, items)
    assert fast_rank(frame, spark.createDataFrame(items, ITEMS)) == want and want
    assert fast_rank(frame, spark.createDataFrame(items, ITEMS), top=3) == slow_rank(docs, items, 3)


def test_small_shards_by_postings_and_several_passes(spark, docs_of, monkeypatch):
    docs, items = corpus(5, 150)
    frame, wanted = docs_of(*[t for _, t in docs], ids=[i for i, _ in docs]), spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(x, "SHARD_POSTINGS", 100)
    monkeypatch.setattr(x, "BLOCK_BYTES", 500)
    assert fast_rank(frame, wanted) == slow_rank(docs, items)


def test_sparse_tables_are_range_maxima():
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 6, 80)
    terms = np.concatenate([rng.permutation(9)[:s] for s in sizes])
    tfs = rng.integers(1, 4, len(terms))
    shard = x.Shard(rng.integers(6, 50, 80), sizes, terms, tfs, np.full(9, 700), 80, 2000)
    for term in range(9):
        a, b = shard.starts[term], shard.starts[term + 1]
        for lo in range(a, b):
            for hi in range(lo + 1, b + 1):
                peak, at = shard._peaks(np.array([lo]), np.array([hi]))
                assert peak[0] == shard.impact[lo:hi].max() and at[0] == lo + shard.impact[lo:hi].argmax()


def test_few_intervals_are_opened(monkeypatch):
    """Documents with the whole item stand out, so next to all of the others stay unscored."""
    rng = np.random.default_rng(2)
    sizes = np.full(4000, 10)
    terms = np.concatenate([rng.permutation(200)[:10] for _ in sizes])
    terms[:100] = np.tile(np.arange(10), 10)
    shard = x.Shard(np.full(4000, 10), sizes, terms, np.ones(len(terms), np.int64), np.full(200, 3000), 4000, 40_000)
    monkeypatch.setattr(x, "BATCH", 1)
    scored = []
    monkeypatch.setattr(x.np, "lexsort", lambda keys, real=np.lexsort: scored.append(1) or real(keys))
    assert [d for d, _ in shard.best(np.arange(10), np.ones(10, np.int64))] == list(range(10)) and len(scored) < 400


def test_awkward_tables(spark, docs_of, awkward, clash, empty):
    items = spark.createDataFrame([(1, "A b, a"), (1, "A b, a"), (2, None), (3, " - "), (None, "w5 c")], ITEMS)
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    want = slow_rank(docs, [(1, "A b, a"), (None, "w5 c")])
    assert fast_rank(awkward, items) == want and fast_rank(clash, items.withColumn("rank", F.lit("x")).withColumn("doc_id", F.lit("y"))) == want
    assert {r[0] for r in want.values()} == {1, 7, None}
    assert x.rank(empty, items).count() == 0 and x.rank(awkward, items.limit(0)).count() == 0
    assert x.rank(docs_of(None, "", "-"), items).count() == 0
    two = spark.createDataFrame([(1, "a"), (1, "w5")], ITEMS)
    assert sorted((r.rank, r.doc_id) for r in x.rank(awkward, two).where("doc_id is not null").collect()) == [(1, 1), (1, 7), (2, 1)]
