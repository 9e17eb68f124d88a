"""One-permutation MinHash fingerprints with optimal densification and packed low bits. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeops.llm.common import let, table

#: Words of a shingle, bins, and low bits kept of each bin.
SHINGLE, BINS, BITS = 5, 256, 4
#: Draws for an empty bin before all filled bins are ranked for it.
DRAWS = 8
#: Rows of a range, in which each row looks at the next one, and the most ranges; more rows make larger ranges.
NEIGHBOURS, MOST_RANGES = 1024, 4096

_SHIFT = 64 - int(math.log2(BINS))
_PER_LONG = 64 // BITS


def shingle_hashes(text: Column) -> Column:
    """64-bit hashes of the text's five-word shingles, lower-cased; of all its words if they are fewer."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")

    def hashed(w: Column) -> Column:
        rolled = F.transform(
            F.slice(w, F.lit(1), F.size(w) - (SHINGLE - 1)),
            lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, SHINGLE)]),
        )
        return F.when(F.size(w) < SHINGLE, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(rolled)

    return let(words, hashed)


def bin_minima(hashes: Column) -> Column:
    """The least hash of each bin, in bin order; an empty bin has its sentinel.

    The top bits of a hash are its bin. A sentinel per bin, greater than any hash there, joins the hashes;
    after sorting, the first of each bin is its minimum.
    """
    sentinels = F.transform(F.sequence(F.lit(-BINS // 2), F.lit(BINS // 2 - 1)), sentinel)
    return let(
        F.sort_array(F.concat(hashes, sentinels)),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, _SHIFT) != F.shiftright(F.get(s, i - 1), _SHIFT))),
    )


def sentinel(top: Column) -> Column:
    return F.shiftleft(top.cast("long"), _SHIFT).bitwiseOR(F.lit(2**_SHIFT - 1).cast("long"))


def densified(minima: Column) -> Column:
    """Minima with each empty bin filled from one that is not empty.

    Optimal densification (Shrivastava, 2017): an empty bin draws bins by a universal hash of its number and
    the draw until one is filled, so that documents alike draw alike. After DRAWS misses the filled bins are
    ranked by a hash for it, which continues the draws without repeats. There is always a filled bin.
    """

    def filled(values: Column, some: Column) -> Column:
        def choose(value: Column, place: Column) -> Column:
            empty = value == sentinel(place - BINS // 2)
            draws = []
            for k in range(DRAWS):
                drawn = F.pmod(F.xxhash64(place, F.lit(k)), F.lit(BINS)).cast("int")
                at = F.get(values, drawn)
                draws.append(F.when(at != sentinel(drawn - BINS // 2), at))
            ranked = F.array_min(
                F.transform(some, lambda x: F.struct(F.xxhash64(place, F.lit(DRAWS), F.shiftright(x, _SHIFT)).alias("rank"), x.alias("value")))
            )["value"]
            return F.when(~empty, value).otherwise(F.coalesce(*draws, ranked))

        return F.transform(values, choose)

    def with_some(values: Column) -> Column:
        some = F.filter(values, lambda x: x != sentinel(F.shiftright(x, _SHIFT)))
        return let(some, lambda s: filled(values, s))

    return let(minima, with_some)


def packed(values: Column) -> Column:
    """The low bits of each bin's value in 64-bit words.

    The value is hashed with its bin's number first: a value that fills several bins then counts as several
    independent draws, also where unlike values share low bits.
    """
    codes = F.transform(values, lambda v, i: F.xxhash64(v, i).bitwiseAND(F.lit(2**BITS - 1).cast("long")))
    words = F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1))
    zero = F.lit(0).cast("long")
    return let(
        codes,
        lambda c: F.transform(
            words,
            lambda k: F.aggregate(F.slice(c, k * _PER_LONG + 1, F.lit(_PER_LONG)), zero, lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x)),
        ),
    )


def signature(text: Column) -> Column:
    """Packed fingerprint of a text as an array of longs. Null counts as empty; texts without words are alike."""
    return packed(densified(bin_minima(shingle_hashes(F.coalesce(text, F.lit(""))))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1: equal bins, less those that agree by chance."""
    ones = F.lit(int("1" * _PER_LONG, 2**BITS)).cast("long")

    def unequal(x: Column, y: Column) -> Column:
        diff = x.bitwiseXOR(y)
        any_bit = diff
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(diff, k))
        return F.bit_count(any_bit.bitwiseAND(ones))

    missed = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, n: s + n)
    chance = 1 / 2**BITS
    return F.greatest(F.lit(0.0), ((BINS - missed) / F.lit(float(BINS)) - chance) / (1 - chance))


def as_hex(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), "")


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` and `signature` of each whole text."""
    return docs.select(*keep, signature(F.col(text)).alias("signature"))


def range_of(number: Column, edges: list[int]) -> Column:
    """How many of the ascending `edges` are at most `number`; -1 for null. Edges are looked through in two steps."""
    step = max(1, math.isqrt(len(edges)))
    coarse, fine = np.array(edges[::step], dtype=np.int64), np.array(edges, dtype=np.int64)

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda e: e <= number))

    if not edges:
        return F.when(number.isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long")
    start = F.greatest(at_most(F.lit(coarse)) - 1, F.lit(0)) * step
    return F.when(number.isNull(), F.lit(-1)).otherwise(start + at_most(F.slice(F.lit(fine), start + 1, F.lit(step)))).cast("long")


def _number(value: int | None) -> str:
    return "NULL" if value is None else f"CAST('{value}' AS BIGINT)"


def with_next(
    docs: DataFrame, values: list[str], derived: Mapping[str, Column] = {}, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, text, `values`, `derived`, and the same as `next_` columns of the document that follows in descending doc_id.

    `derived` are expressions of `text`, worked out once per row before the shuffle.

    After the last comes the first; a single document follows itself. Null ids come last; rows that share an
    id are ordered by a hash of their text. Ids are cut into ranges of about NEIGHBOURS rows at quantiles of the ids
    themselves, so clustered ids make no larger ones; each is sorted by itself, and its first row is copied to the
    range before it. Texts are shuffled once. Rows of one id, and those of none, share a range.
    """
    tie = F.xxhash64(text)
    ids = docs.select(F.col(doc_id).alias("doc_id"), tie.alias("tie"))
    ranges = min(MOST_RANGES, -(-max(1, ids.count()) // NEIGHBOURS))
    cuts = [k / ranges for k in range(1, ranges)]
    edges = ids.agg(F.percentile_approx("doc_id", cuts, 10 * ranges)).first()[0] if cuts else None
    bucket = range_of(F.col("doc_id"), sorted(set(edges or [])))
    first = F.max(F.struct(F.col("doc_id"), (-F.col("tie")).alias("tie"))).alias("first")
    heads = sorted(ids.withColumn("bucket", bucket).groupBy("bucket").agg(first).collect())  # a row per range
    after = heads[1:] + heads[:1]
    values_ = ", ".join(f"({n['bucket']}L, {_number(h['first']['doc_id'])}, {_number(-h['first']['tie'])})" for h, n in zip(heads, after))
    target = docs.sparkSession.sql(f"SELECT * FROM VALUES {values_ or '(0L, NULL, NULL)'} AS t(bucket, _id, _tie)")
    target = target.select("bucket", F.col("_id").cast("long"), F.col("_tie").cast("long"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), tie.alias("tie"), *values)
    copies = rows.join(target, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")))
    columns = ["doc_id", "text", "tie", *values, "bucket"]
    copies = copies.select(*columns, F.lit(True).alias("copy"))  # a row that repeats gives equal copies, of which the first counts
    both = rows.withColumn("bucket", bucket).select(*columns, F.lit(False).alias("copy")).union(copies)
    both = both.withColumns(dict(derived))
    line = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").desc_nulls_last(), "tie")
    shown = ["text", *values, *derived]
    # A lead per column: a lead of a struct would carry all of them twice through the shuffle.
    following = {f"next_{v}": F.lead(v).over(line) for v in shown}
    return both.withColumns(following).where("not copy").select("doc_id", *shown, *following)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(docs, [], {"signature": signature(F.col("text"))})
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    pairs = pairs.withColumn("edited", F.concat(F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut)))
    pairs = pairs.withColumn("edited_signature", signature(F.col("edited")))
    return pairs.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_hex(F.col("signature")).alias("fingerprint"),
        as_hex(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
