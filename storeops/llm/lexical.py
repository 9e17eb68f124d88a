"""Ranked lexical search: best-first document intervals over posting lists with range-maximum sparse tables.

A shard is a run of documents, numbered by ascending id. For each term it has a posting list of (document,
impact) with a sparse table that tells the greatest impact of any range. The summed maxima of an item's terms
bound the score of all documents of an interval. The interval with the highest bound is split at the document
of its greatest impact, which is scored exactly, until no bound reaches the scores already found.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from storeops.llm.common import ASCII_LOWER, blocks_of, slices, table, written

#: Documents told for each item.
TOP = 10
#: Bytes of item text that one pass over the documents ranks for; more items take more passes.
BLOCK_BYTES = 8 << 20
#: A shard ends at so many documents or postings, whichever comes first.
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 20
#: Intervals that are split side by side, at most.
BATCH = 128

#: A-Z to a-z, ASCII letters, digits and all bytes above ASCII stay, all else separates.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in ASCII_LOWER)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Block:
    """Items with their terms, by number, and how often each stands in the item."""

    ids: list
    queries: list[tuple[np.ndarray, np.ndarray]]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple]) -> Block:
        vocabulary: dict[bytes, int] = {}
        ids, queries = [], []
        for number, text in rows:
            counts = Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text))
            if counts:
                ids.append(number)
                queries.append((np.fromiter(counts.keys(), np.int64), np.fromiter(counts.values(), np.int64)))
        return cls(ids, queries, vocabulary)


class Shard:
    """Posting lists of some documents, one after the other, each sorted by document, with their sparse table."""

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, total_docs: int, total_terms: int):
        """`sizes` are the documents' numbers of `terms` (and `tfs`); documents come by ascending id."""
        self.docs = len(lengths)
        doc = np.repeat(np.arange(self.docs, dtype=np.int64), sizes)
        norm = 25 + (75 * lengths * total_docs) // total_terms
        impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * norm[doc]))
        some = impact > 0
        keys = terms[some] * self.docs + doc[some]
        order = np.argsort(keys)
        self.keys, self.impact = keys[order], impact[some][order]
        self.starts = np.searchsorted(self.keys, np.arange(len(weights) + 1, dtype=np.int64) * self.docs)
        longest = int(np.diff(self.starts).max(initial=0))
        # Row j has the place of the greatest impact among 2**j postings from each place on, the first of equal ones.
        rows = [np.arange(len(self.keys), dtype=np.int32)]
        for j in range(1, longest.bit_length()):
            half, last = 1 << j - 1, rows[-1]
            a, b = last[: len(last) - half], last[half:]
            better = np.where(self.impact[b] > self.impact[a], b, a)
            rows.append(np.concatenate([better, last[len(last) - half :]]))
        self.table = np.stack(rows)

    def _peaks(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest impact and its place in each range of postings; 0 where a range is empty."""
        size = end - begin
        some = size > 0
        level = np.frexp(np.maximum(size, 1))[1] - 1
        a = self.table[level, np.where(some, begin, 0)]
        b = self.table[level, np.where(some, end - (1 << level), 0)]
        at = np.where(self.impact[b] > self.impact[a], b, a)
        return np.where(some, self.impact[at], 0), at

    def best(self, terms: np.ndarray, repeats: np.ndarray, top: int = TOP) -> list[tuple[int, int]]:
        """(document, score) of the `top` highest scores above 0, equal scores by document."""
        begin, end = self.starts[terms], self.starts[terms + 1]
        held = end > begin
        if not held.any():
            return []
        base, repeats = (terms[held] * self.docs)[:, None], repeats[held][:, None]

        def bounded(lo, hi, a, b):
            peaks, at = self._peaks(a, b)
            peaks = peaks * repeats
            bound, lead = peaks.sum(axis=0), peaks.argmax(axis=0)
            split = self.keys[at[lead, np.arange(len(lo))]] - base[lead, 0]
            return lo, hi, a, b, bound, split

        lo, hi, a, b, bound, split = bounded(np.array([0]), np.array([self.docs]), begin[held][:, None], end[held][:, None])
        docs, scores, batch = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        while len(lo):
            pick = np.argpartition(-bound, batch - 1)[:batch] if len(lo) > batch else np.arange(len(lo))
            mid = split[pick]
            place = np.searchsorted(self.keys, base + mid)
            hit = self.keys[np.minimum(place, len(self.keys) - 1)] == base + mid
            score = (np.where(hit, self.impact[np.minimum(place, len(self.keys) - 1)], 0) * repeats).sum(axis=0)
            docs, scores = np.concatenate([docs, mid]), np.concatenate([scores, score])
            order = np.lexsort((docs, -scores))[:top]
            docs, scores = docs[order], scores[order]
            halves = bounded(
                np.concatenate([lo[pick], mid + 1]),
                np.concatenate([mid, hi[pick]]),
                np.concatenate([a[:, pick], place + hit], axis=1),
                np.concatenate([place, b[:, pick]], axis=1),
            )
            rest = np.ones(len(lo), dtype=bool)
            rest[pick] = False
            lo, hi, a, b, bound, split = (np.concatenate([x[..., rest], y], axis=-1) for x, y in zip((lo, hi, a, b, bound, split), halves))
            least, last = (scores[-1], docs[-1]) if len(docs) == top else (0, self.docs)
            open_ = (bound > least) | ((bound == least) & (bound > 0) & (lo < last))
            lo, hi, a, b, bound, split = (x[..., open_] for x in (lo, hi, a, b, bound, split))
            batch = min(BATCH, 2 * batch)
        return list(zip(docs.tolist(), scores.tolist()))


def postings(docs: DataFrame, block: Block, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (terms of the whole text), and the block's `terms` in it with their `tfs`; texts without terms go."""
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", frame.schema["doc_id"].dataType)])
    schema = schema.add("n", T.LongType()).add("terms", T.ArrayType(T.IntegerType(), False)).add("tfs", T.ArrayType(T.IntegerType(), False))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = block.vocabulary.get
        for batch in batches:
            for piece in slices(batch, 1):
                rows, lengths, terms, tfs = [], [], [], []
                for i, value in enumerate(piece.column(1).cast(pa.binary()).to_pylist()):
                    words = terms_of(value or b"")
                    if words:
                        counts = Counter(map(number, words))
                        counts.pop(None, None)
                        rows.append(i)
                        lengths.append(len(words))
                        terms.append(list(counts.keys()))
                        tfs.append(list(counts.values()))
                columns = [lengths, terms, tfs]
                made = [pa.array(c, type=arrow.field(k + 1).type) for k, c in enumerate(columns)]
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(rows, pa.int32())), *made], schema=arrow)

    return frame.mapInArrow(run, schema)


def shard_bests(found: DataFrame, block: Block, item_type: T.DataType, weights: np.ndarray, total_docs: int, total_terms: int, top: int) -> DataFrame:
    """item, item_id, doc_id and score of each shard's best documents for each item of the block."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type), found.schema["doc_id"], T.StructField("score", T.LongType())])
    arrow = to_arrow_schema(schema)

    def ranked(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        rows = rows.take(pc.sort_indices(rows["doc_id"])).combine_chunks()
        lists = [rows[c].chunk(0) if rows[c].num_chunks else pa.array([], rows[c].type) for c in ("terms", "tfs")]
        sizes = pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False).astype(np.int64)
        terms, tfs = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
        shard = Shard(rows["n"].to_numpy().astype(np.int64), sizes, terms, tfs, weights, total_docs, total_terms)
        hits = [(q, d, s) for q, query in enumerate(block.queries) for d, s in shard.best(*query, top)]
        items, docs, scores = zip(*hits) if hits else ((), (), ())
        ids = rows["doc_id"].take(pa.array(docs, pa.int64())).combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) and ids.num_chunks else pa.array([], arrow.field("doc_id").type) if isinstance(ids, pa.ChunkedArray) else ids
        made = [pa.array(items, pa.int32()), pa.array([block.ids[q] for q in items], arrow.field("item_id").type), ids, pa.array(scores, pa.int64())]
        return pa.RecordBatch.from_arrays(made, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs, size = [], 0, 0
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                room = np.searchsorted(ends, (ends[start - 1] if start else 0) + SHARD_POSTINGS - size, side="right") - start
                take = max(1 if not parts else 0, min(int(room), SHARD_DOCS - docs, batch.num_rows - start))
                if take:
                    parts.append(batch.slice(start, take))
                    docs += take
                    size += int(ends[start + take - 1] - (ends[start - 1] if start else 0))
                    start += take
                if not take or docs >= SHARD_DOCS or size >= SHARD_POSTINGS:
                    yield ranked(parts)
                    parts, docs, size = [], 0, 0
        if parts:
            yield ranked(parts)

    return found.mapInArrow(run, schema)


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the `top` documents of highest score above 0 for each item.

    Equal scores are ranked by ascending doc_id, null ids last. Each row of `docs` is a document, so repeated
    rows are ranked one after the other; null, blank and other texts without a term count in no statistic. Equal
    rows of `items` are one item; unlike texts of one item id are ranked apart, a null item id is an id like any
    other, an item without terms has no rows. Statistics cover all documents. Other columns are not read. The
    items are ranked in blocks of BLOCK_BYTES, a pass over the documents each.
    """
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("text is not null").distinct()
    item_type, out = wanted.schema["item_id"].dataType, None
    for rows in blocks_of(wanted, F.octet_length("text"), BLOCK_BYTES):
        block = Block.of([(r["item_id"], r["text"].encode()) for r in rows])
        found = written(postings(docs, block, doc_id, text), "postings")
        total_docs, total_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
        held = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.log((2 * F.lit(total_docs) + 2) / (2 * F.col("df") + 1)))
        weights = np.zeros(max(1, len(block.vocabulary)), dtype=np.int64)
        for term, w in held.select("term", weight.cast("long")).collect():  # a row per term of the block
            weights[term] = w
        best = shard_bests(found, block, item_type, weights, total_docs, total_terms, top)
        place = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = written(best, "shard-bests").withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
        best = best.select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return out


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: All documents scored for all items, for tables whose ids are unique.
OP12_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS.format("coalesce(text, '')")} AS ts FROM documents),
     i AS (SELECT item_id, unnest({_TERMS.format("coalesce(text, '')")}) AS term FROM benchmark),
     s AS (SELECT count(*) AS total_docs, CAST(sum(len(ts)) AS BIGINT) AS total_terms FROM d WHERE len(ts) > 0),
     tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) u GROUP BY ALL),
     w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * total_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, total_docs),
     q AS (SELECT item_id, term, count(*) AS r FROM i GROUP BY ALL),
     scores AS (SELECT item_id, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * total_docs) // total_terms)))) AS BIGINT) AS score
                FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {TOP}
"""
