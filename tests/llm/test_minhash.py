"""Edited texts and likeness against exact sets; the order of neighbours; awkward rows."""

import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from conftest import sha
from storeops.llm import minhash as m

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def edited(text, following):
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def test_query(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    rows = m.op2_minhash(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    prints, errors, far = {}, [], []
    for r in rows:
        text, following = texts[r.doc_id], texts[after[r.doc_id]]
        new = edited(text, following)
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(new))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == len(r.edited_fingerprint) == m.BINS * m.BITS // 4
        errors.append(r.near_edited - jaccard(text, new))
        far.append(r.near_next - jaccard(text, following))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05 and max(map(abs, errors)) < 0.2
    assert max(map(abs, far)) < 0.2
    plan = m.op2_minhash(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sparse_texts_are_filled_alike(spark):
    """One to three shingles fill all bins; likeness follows the sets, and filling is deterministic."""
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[a : a + n]) for a in range(20) for n in (5, 6, 7)] + ["a b", "a b", "c d", "", " "]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    prints = frame.select("i", "text", m.signature(F.col("text")).alias("s"))
    pairs = prints.join(prints.selectExpr("i AS j", "text AS other", "s AS o"), F.expr("i < j"))
    errors = [r.l - jaccard(r.text, r.other) for r in pairs.select("text", "other", m.likeness(F.col("s"), F.col("o")).alias("l")).collect()]
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.35


def test_neighbours_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(m, "NEIGHBOURS", 3)
    ids = [-50, -3, 0, 1, 2, 5, 6, 7, 8, 9, 10, 40, 1000, 1001, 2**62, -(2**62)]
    frame = spark.createDataFrame([(i, f"t{i}", i) for i in ids], "doc_id long, text string, v long")
    order = sorted(ids, reverse=True)
    got = {r.doc_id: (r.next_text, r.next_v) for r in m.with_next(frame, ["v"]).collect()}
    assert got == {a: (f"t{b}", b) for a, b in zip(order, order[1:] + order[:1])}


def test_awkward_rows(spark, awkward, clash, empty, docs_of, tmp_path):
    awkward.write.parquet(str(tmp_path / "a" / "documents.parquet"))
    rows = m.op2_minhash(spark, str(tmp_path / "a")).collect()
    assert len(rows) == 7 and {r.n_chars for r in rows if r.doc_id in (2, 3)} == {0}
    assert len({r.fingerprint for r in rows if r.doc_id in (1, None)}) == 1
    following = {r.doc_id: r.next_text for r in m.with_next(awkward, []).collect()}
    assert following[7] == " \n " and following[4] == "" and following[None][:3] == "w0 "
    empty.write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert m.op2_minhash(spark, str(tmp_path / "b")).count() == 0
    docs_of("only one here").write.parquet(str(tmp_path / "c" / "documents.parquet"))
    (row,) = m.op2_minhash(spark, str(tmp_path / "c")).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == sha(edited("only one here", "only one here"))
    assert m.fingerprints(clash, ["doc_id", "score"]).count() == 7


def test_an_outlier_and_clustered_ids_make_no_large_range(spark):
    ids = [2**60, -(2**62), *range(10_000), *(7 << 40 | k for k in range(10_000))]
    frame = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    edges = []
    real = m.range_of
    try:
        m.range_of = lambda number, cut: edges.extend(cut) or real(number, cut)
        got = {r.doc_id for r in m.with_next(frame, []).collect()}
    finally:
        m.range_of = real
    sizes = frame.groupBy(real(F.col("doc_id"), edges).alias("b")).count().collect()
    assert got == set(ids) and max(r["count"] for r in sizes) <= 2 * len(ids) / len(sizes) and len(sizes) > 10
    plan = m.with_next(frame, [])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_ranges(spark):
    for edges in ([], [3], [1, 2, 5, 9, 40], list(range(0, 300, 3))):
        numbers = [None, -(2**63), 0, 1, 2, 4, 9, 39, 40, 299, 2**62]
        got = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", m.range_of(F.col("n"), edges).alias("r")).collect()
        assert all(r.r == (-1 if r.n is None else sum(e <= r.n for e in edges)) for r in got)
