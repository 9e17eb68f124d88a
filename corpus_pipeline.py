"""The corpus pipeline: documents in, encoded documents out, one written table per stage.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns a DataFrame; all
but the last return the columns of documents. An empty table passes through every stage. Null texts count as
empty ones. Extra columns of the documents travel along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storeops.llm import bpe, decontaminate, quality, secrets, simhash
from storeops.llm.common import table, written


def drop_bad_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by SimHash links or by the likeness of their five-word shingles, that with the smallest id."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and n_chars set anew where that happened."""
    return secrets.redact(docs)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids with their end offsets, and whether decoding them gives the text again."""
    return bpe.encode_checked(docs)


STAGES = [
    ("quality classifier", drop_bad_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("byte-level BPE", encode_documents),
]

#: The classifier, the fingerprints and the tokenizer cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
