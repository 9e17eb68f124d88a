"""The pipeline against the operators applied one by one in plain Python."""

import duckdb
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from storeops.llm import bpe, decontaminate, quality, simhash
from storeops.llm.common import table
from test_likeness import slow_kept
from test_secrets import base, hot

SF = "/root/testdata/sf0.001"


def masked(text):
    known = base(text)
    spans = sorted(known + [h for h in hot(text) if not any(b[0] <= h[0] and h[1] <= b[1] for b in known)])
    out, at = "", 0
    for a, b, _ in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    model = quality.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    good, bad = model.compressors()
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    docs = [(i, t) for i, t in docs if 1 / (1 + 2.718281828459045 ** -(quality.saving(t.encode(), good, bad) * model.slope + model.offset)) >= 0.3]
    first = set(slow_kept(docs)[0])  # fingerprints two bits apart, or five-word shingle sets alike
    docs = [(i, t) for i, t in docs if i in first]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    matcher = decontaminate.Matcher.of([(i, decontaminate.fold(t.encode())) for i, t in items])
    docs = [(i, masked(t)) for i, t in docs if not matcher.search(decontaminate.fold(t.encode()))]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        codec = bpe.Codec.of(file.read(), bpe.code_point_classes())
    want = {i: ids.tolist() for (i, _), ids in zip(docs, codec.encode([t for _, t in docs]))}
    assert {r.doc_id: list(r.ids) for r in rows} == want
    assert all(r.exact and r.n_tokens == len(r.ids) for r in rows)


def test_stages_keep_columns_and_survive_awkward_tables(spark, awkward, clash, empty):
    for docs in (clash, empty):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
        assert last.filter(~F.col("exact")).count() == 0
    assert last.count() == 0


def test_registration():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in names} and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    assert set(entry.oracle_sql()) <= names
