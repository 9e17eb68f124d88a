"""Quality by compression: one zstandard dictionary of good text, one of bad text, and their size difference."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.llm.common import held_out, map_texts, table, written

#: Bounds of the labelled sample: label rows of a class, and pieces of a class that train its dictionary.
LABEL_ROWS, PIECES = 4000, 4000
#: Bytes of a piece. Pieces are compressed apart, so a long text cannot teach the compressor its own words.
PIECE = 512
DICTIONARY, LEVEL = 32768, 3
#: A document is good from this score on.
GOOD = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and a logistic curve from bytes saved per byte to a probability."""

    good: bytes
    bad: bytes
    slope: float
    offset: float

    def compressors(self) -> tuple:
        return tuple(_compressor(d) for d in (self.good, self.bad))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_content_size": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **options)


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def saving(text: bytes, good, bad) -> float:
    """Bytes per byte that the good dictionary saves over the bad one, over all pieces of the text."""
    if not text:
        return 0.0
    return sum(len(bad.compress(p)) - len(good.compress(p)) for p in pieces(text)) / (len(text) + 1)


def _trained(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; plain samples serve where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one feature by Newton steps, with a little shrinkage."""
    scale = float(x.std()) or 1.0
    z = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    ridge = np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (weight * (y - p)) - ridge @ beta)
        beta += step
        if abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """Dictionaries and curve from at most LABEL_ROWS labelled rows of each class outside the held-out fifth.

    Half of the sample's documents give the pieces that train the dictionaries, the other half the curve;
    classes are weighted by their share of all labels that may be learned from. Only the sample's ids are
    joined with the documents, and at most PIECES pieces of a class and one number per document come to the
    driver. Without labels of both classes every text scores 0.5.
    """
    ids = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
    ids = ids.where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    shares = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return QualityModel(b"", b"", 0.0, 0.0)
    order = F.xxhash64("doc_id")
    some = [ids.where(F.col("y") == y).orderBy(order, "doc_id").limit(LABEL_ROWS) for y in (0, 1)]
    sample = written(some[0].union(some[1]).withColumn("half", F.pmod(order, F.lit(2))), "quality-ids")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(sample, "doc_id")
    texts = written(texts, "quality-sample")

    def cut():
        return lambda batch: [[pieces(t) for t in batch]]

    cuts = map_texts(texts.where("half = 0"), ["doc_id", "y"], "pieces array<binary>", cut)
    cuts = cuts.select("doc_id", "y", F.explode("pieces").alias("piece"))
    dictionaries = []
    for y in (1, 0):
        rows = cuts.where(F.col("y") == y).orderBy(F.xxhash64("piece", "doc_id"), "doc_id", "piece").limit(PIECES)
        dictionaries.append(_trained([bytes(r["piece"]) for r in rows.select("piece").collect()]))
    model = QualityModel(dictionaries[0], dictionaries[1], 0.0, 0.0)
    curve = savings(texts.where("half = 1"), ["doc_id", "y"], model).select("y", "saving").collect()
    y = np.array([r["y"] for r in curve], dtype=float)
    if not len(y) or y.min() == y.max():
        return model
    x = np.array([r["saving"] for r in curve])
    weight = np.where(y == 1, shares[1] / y.sum(), shares[0] / (1 - y).sum())
    slope, offset = _curve(x, y, weight * len(y) / weight.sum())
    return QualityModel(model.good, model.bad, slope, offset)


def savings(docs: DataFrame, keep: list[str], model: QualityModel, text: str = "text") -> DataFrame:
    """`keep` and the normalised compressed-size difference of each whole text."""

    def worker():
        good, bad = model.compressors()
        return lambda texts: [[saving(t, good, bad) for t in texts]]

    return map_texts(docs, keep, "saving double", worker, text)


def score(docs: DataFrame, keep: list[str], model: QualityModel, text: str = "text") -> DataFrame:
    """`keep`, and `score`: the calibrated probability that a text is good. Equal texts score alike.

    Null and empty texts save nothing and get the curve's value there. Only the text is read.
    """
    slope, offset = model.slope, model.offset
    line = F.col("saving") * slope + offset
    return savings(docs, keep, model, text).select(*keep, (1 / (1 + F.exp(-line))).alias("score"))


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text scores GOOD or more."""
    slope, offset = model.slope, model.offset
    position = docs.columns.index(text)

    import pyarrow as pa

    from storeops.llm.common import SLICE

    def run(batches):
        good, bad = model.compressors()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                piece = batch.slice(start, SLICE)
                texts = piece.column(position).cast(pa.binary()).to_pylist()
                stay = [1 / (1 + math.exp(-(saving(t or b"", good, bad) * slope + offset))) >= GOOD for t in texts]
                yield piece.filter(pa.array(stay))

    return docs.mapInArrow(run, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, ["doc_id"], model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )
