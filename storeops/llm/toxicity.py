"""Toxicity from confirmed examples and unlabelled text: non-negative positive-unlabelled learning in numpy."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.llm.common import ASCII_LOWER, held_out, map_texts, table, written

#: Bounds of the sample: confirmed toxic documents and unlabelled ones.
POSITIVES, UNLABELLED = 3000, 6000
#: Documents of the sample that must hold a feature, and standard errors by which its share must differ
#: between confirmed and unlabelled documents for it to be weighed.
LEAST_DOCS, LEAST_Z = 5, 4.0
#: Bytes of the word beginnings that are features beside whole words.
PREFIXES = (4, 6)
ROUNDS, RATE = 300, 0.05
#: Share of toxic text where the labels give none.
DEFAULT_PRIOR = 0.1

_EDGES = b".,;:!?\"'()[]{}<>|*#%&$"


def features(text: bytes) -> list[int]:
    """Distinct hashes of the lower-cased words of a text, and of their beginnings."""
    words = {w.strip(_EDGES) for w in set(text.translate(ASCII_LOWER).split())}
    words.discard(b"")
    found = set(words)
    for size in PREFIXES:
        found.update([w[:size] + b"*" for w in words if len(w) >= size])
    return list(map(zlib.crc32, found))


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[int, float]
    offset: float


def nnpu(
    rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, width: int, prior: float
) -> tuple[np.ndarray, float]:
    """Weights of a linear classifier under the non-negative risk estimator (Kiryo and others, 2017).

    Document `rows[k]` holds feature `columns[k]`; `positive` marks confirmed documents, all others are
    unlabelled, a mixture with a share `prior` of positives. The risk of calling negatives positive is that
    of the unlabelled less the positives' part in it. Where that difference falls below zero, which no true
    risk does, the step goes against it instead. Adam; the weights shrink as if by one unlabelled document.
    """
    count, n_pos = len(positive), max(1, positive.sum())
    n_unl = max(1, count - n_pos)
    weights = np.zeros(width + 1)
    weights[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(rows, weights[columns], minlength=count) + weights[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss_neg = np.logaddexp(0, z)
        negative = loss_neg[~positive].sum() / n_unl - prior * loss_neg[positive].sum() / n_pos
        pull = np.where(positive, prior * (p - 1) / n_pos, 0.0)
        push = np.where(positive, -prior * p / n_pos, p / n_unl)
        slope = pull + push if negative >= 0 else -push
        grad = np.append(np.bincount(columns, slope[rows], minlength=width), slope.sum())
        grad[:-1] += weights[:-1] / n_unl
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        weights -= RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return weights[:-1], float(weights[-1])


def telling(found: DataFrame, n_pos: int, n_unl: int) -> DataFrame:
    """(feature) of those in LEAST_DOCS documents or more whose shares differ by LEAST_Z standard errors."""
    held = found.select("mark", F.explode("found").alias("feature"))
    counts = held.groupBy("feature").agg(
        F.sum(F.col("mark").cast("int")).alias("in_pos"), F.sum((~F.col("mark")).cast("int")).alias("in_unl")
    )
    share = (F.col("in_pos") + F.col("in_unl")) / (n_pos + n_unl)
    error = F.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_unl)) + 1e-12
    apart = F.abs(F.col("in_pos") / n_pos - F.col("in_unl") / n_unl) >= LEAST_Z * error
    return counts.where(apart & (F.col("in_pos") + F.col("in_unl") >= LEAST_DOCS)).select("feature")


def learn(found: DataFrame, prior: float) -> ToxicityModel:
    """A model of the sample's documents: (row, doc_id, mark, found), `found` their distinct features.

    Features are counted and screened in Spark; only documents' marks and which screened features they hold
    come to the driver. Documents are ordered by id, so equal samples give equal models.
    """
    docs = found.select("row", "doc_id", "mark").orderBy("doc_id", "mark", "row").toArrow()
    positive, ids = docs["mark"].to_numpy().astype(bool), docs["row"].to_numpy()
    n_pos = int(positive.sum())
    if not n_pos:
        return ToxicityModel({}, float(np.log(prior / (1 - prior))))
    kept = written(telling(found, n_pos, max(1, len(positive) - n_pos)), "features")
    held = found.select("row", F.explode("found").alias("feature")).join(kept, "feature").toArrow()
    names, columns = np.unique(held["feature"].to_numpy(), return_inverse=True)
    place = np.argsort(ids)
    rows = place[np.searchsorted(ids[place], held["row"].to_numpy())]
    order = np.lexsort((columns, rows))
    weights, offset = nnpu(rows[order], columns[order], positive, len(names), prior)
    heavy = np.flatnonzero(np.abs(weights) > 1e-4)
    return ToxicityModel(dict(zip(names[heavy].tolist(), weights[heavy].tolist())), offset)


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", prior: float | None = None
) -> ToxicityModel:
    """A model from at most POSITIVES confirmed toxic documents and UNLABELLED others, none held out.

    The unlabelled ones are drawn from all documents, whatever their label. `prior` is the toxic share of
    all text; by default the share among the labels that may be learned from. Only the sample's ids are
    joined with the documents. Without toxic labels every text gets the prior.
    """
    free = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y")).where(free & F.col("y").isin(0, 1))
    marks = marks.distinct()
    if prior is None:
        prior = marks.agg(F.avg("y")).first()[0]
        prior = min(max(prior, 0.001), 0.5) if prior else DEFAULT_PRIOR
    order = F.xxhash64("doc_id")
    confirmed = marks.where("y = 1").orderBy(order, "doc_id").limit(POSITIVES)
    others = docs.select(F.col(doc_id).alias("doc_id")).where(free).distinct().orderBy(order, "doc_id").limit(UNLABELLED)
    chosen = written(
        confirmed.select("doc_id", F.lit(True).alias("mark")).union(others.select("doc_id", F.lit(False).alias("mark"))), "toxicity-ids"
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, "doc_id")

    def worker():
        return lambda batch: [[sorted(set(features(t))) for t in batch]]

    found = map_texts(texts, ["doc_id", "mark"], "found array<long>", worker)
    return learn(written(found.withColumn("row", F.monotonically_increasing_id()), "toxicity-sample"), prior)


def score(docs: DataFrame, keep: list[str], model: ToxicityModel, text: str = "text") -> DataFrame:
    """`keep`, and `score`: the model's probability that a whole text is toxic. Equal texts score alike.

    Null, empty and wordless texts score by the offset alone. Only the text is read.
    """
    weights, offset = model.weights, model.offset

    def worker():
        get = weights.get

        def run(texts: list[bytes]) -> list:
            z = np.array([sum(get(f, 0.0) for f in sorted(features(t))) for t in texts]) + offset
            return [1 / (1 + np.exp(-np.clip(z, -700, 700)))]

        return run

    return map_texts(docs, keep, "score double", worker, text)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, ["doc_id"], model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
