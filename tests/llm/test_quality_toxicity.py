"""Held-out accuracy of the two classifiers, and that labels of the held-out fifth never count."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from storeops.llm import quality, toxicity
from storeops.llm.common import table

SF = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


@pytest.mark.parametrize(
    "query, label, threshold, least",
    [(quality.op9_quality, "quality", 0.3, 0.95), (toxicity.op4_toxicity, "toxic", 0.5, 0.75)],
)
def test_query(spark, query, label, threshold, least):
    """Small tables hold some 50 toxic labels, so the bound for them is low."""
    out = query(spark, SF).toPandas()
    assert sorted(out.columns) == ["doc_id", "held_out", "predicted", "score"]
    ids = [i for (i,) in duckdb.sql(f"SELECT doc_id FROM '{SF}/documents.parquet'").fetchall()]
    assert sorted(out.doc_id) == sorted(ids)
    assert list(out.held_out) == [held(i) for i in out.doc_id]
    assert out.score.between(0, 1).all() and list(out.predicted) == [int(s >= threshold) for s in out.score]
    both = out.merge(duckdb.sql(f"SELECT doc_id, {label} AS y FROM '{SF}/labels.parquet'").df(), on="doc_id")
    test = both[both.held_out]
    assert auc(test.score.values, test.y.values) >= least


@pytest.mark.parametrize("fit, label", [(quality.fit, "quality"), (toxicity.fit, "toxic")])
def test_held_out_labels_do_not_count(spark, fit, label):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn(label, F.when(hidden, 1 - F.col(label)).otherwise(F.col(label)))
    assert fit(docs, flipped) == fit(docs, labels)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows(spark, awkward, clash, empty, module):
    labels = spark.createDataFrame([(1, 1, 1), (7, 0, 0), (None, 1, 1), (1, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for docs in (awkward, clash):
        model = module.fit(docs, labels)
        rows = module.score(docs, ["doc_id"], model).collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
        alike = [r.score for r in rows if r.doc_id in (1, None)]
        assert len(set(alike)) == 1 and len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    none = module.fit(empty, labels.limit(0))
    assert module.score(empty, ["doc_id"], none).count() == 0
    assert len({r.score for r in module.score(awkward, ["doc_id"], none).collect()}) == 1


def test_keep_good_keeps_columns(clash, empty):
    model = quality.QualityModel(b"", b"", 0.0, 0.0)
    assert sorted(map(str, quality.keep_good(clash, model).collect())) == sorted(map(str, clash.collect()))
    assert quality.keep_good(empty, model).count() == 0
    assert quality.keep_good(clash, quality.QualityModel(b"", b"", 0.0, -5.0)).count() == 0


def test_nnpu_learns_a_planted_feature():
    """A third of the unlabelled are positive; the risk estimator still tells the feature from noise."""
    rng = np.random.default_rng(3)
    positive = np.arange(900) < 300
    toxic = positive | (np.arange(900) >= 700)
    rows, columns = [], []
    for i in range(900):
        for c in {*rng.integers(1, 40, 6).tolist()} | ({0} if toxic[i] else set()):
            rows.append(i)
            columns.append(c)
    weights, offset = toxicity.nnpu(np.array(rows), np.array(columns), positive, 40, 1 / 3)
    z = np.bincount(rows, weights[columns], minlength=900) + offset
    assert ((z > 0) == toxic).mean() > 0.98
