"""The prefix trie of conversations, by count-min screening of prefix digests.

A prefix is known by its depth and a digest that the turns' hashes add up to. A count-min sketch of all digests
tells which prefixes only one conversation can have: the sketch never counts too low, so an estimate of one is a
proof. From there on a conversation is alone, and the rest of it is given out as it stands. Only prefixes that may
be shared are shuffled and grouped exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from storeops.llm.common import table, written

#: Cells of each of the sketch's two rows: eight per prefix, and at most 2 ** MOST_BITS, which is 16 MB for both.
CELLS_PER_PREFIX, LEAST_BITS, MOST_BITS = 8, 10, 26
#: Rows of one conversation that share a window.
BLOCK = 4096
#: Ids of this many bits differ within a chunk of a member list, so a chunk has at most 2 ** CHUNK_BITS of them.
CHUNK_BITS = 9
#: The query: conversations that begin with turns of another one.
LENDER_EVERY, MOST_LENT = 20, 4

WORDS = r"[^\x20\x09-\x0D]+"
_BITMAP = 32768


def numbered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, pos (from 1), two hashes a and b of role and text, and the text's words, for each turn.

    Turns are ordered by turn, null first; equal ones by role, then by the text's XXH64 (seed 42). Null roles and
    texts become empty, rows without a conversation id go. Rows are dealt out in ranges of the whole order, so a
    long conversation is numbered by several tasks.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), body.alias("text"))
    rows = rows.where("conv_id is not null").select(
        "conv_id", "turn", "role", F.xxhash64("text").alias("tie"), F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.length("role"), "text", "role").alias("b"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    rows = rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    rows = written(rows, "turns")
    sizes = rows.groupBy("conv_id", "part").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv_id", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    placed = rows.withColumn("inside", inside).join(sizes, ["conv_id", "part"])
    return placed.select("conv_id", (F.col("inside") + F.col("before")).alias("pos"), "a", "b", "words")


def running(rows: DataFrame, place: Column, columns: list[str], total: Callable[[str], Column], plus: Callable[[Column, Column], Column]) -> DataFrame:
    """`rows`, each of `columns` replaced by its total over the conversation's rows up to this `place`.

    Blocks of places are totalled by themselves and then added up, so a long conversation is many windows.
    """
    rows = rows.withColumn("_place", place).withColumn("_block", F.floor(F.col("_place") / BLOCK))
    inside = Window.partitionBy("conv_id", "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "_block").agg(*[total(c).alias(c) for c in columns])
    before = blocks.select("conv_id", "_block", *[F.coalesce(total(c).over(earlier), F.lit(0).cast("long")).alias(f"_{c}") for c in columns])
    rows = rows.withColumns({c: total(c).over(inside) for c in columns}).join(before, ["conv_id", "_block"])
    return rows.withColumns({c: plus(F.col(c), F.col(f"_{c}")) for c in columns}).drop("_place", "_block", *[f"_{c}" for c in columns])


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, size (of the conversation), words, digest (a, b) and parent's digest (pa, pb) of each prefix.

    A digest is the exclusive or of the hashes of (place, turn) in two independent 64-bit halves.
    """
    tagged = turns.select("conv_id", F.col("pos").alias("depth"), "words", F.xxhash64("pos", "a").alias("own_a"), F.xxhash64("pos", "b").alias("own_b"))
    tagged = tagged.withColumns({"a": F.col("own_a"), "b": F.col("own_b")})
    found = running(tagged, F.col("depth"), ["a", "b"], F.bit_xor, lambda x, y: x.bitwiseXOR(y))
    found = found.withColumns({"pa": F.col("a").bitwiseXOR(F.col("own_a")), "pb": F.col("b").bitwiseXOR(F.col("own_b"))})
    return found.join(convs.select("conv_id", "size"), "conv_id").select("conv_id", "depth", "size", "words", "a", "b", "pa", "pb")


def crowded_cells(found: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for each cell of the sketch that counts two or more prefixes, and the number of bits of a cell's place."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(CELLS_PER_PREFIX * max(1, found.count())))))
    width = 1 << bits
    cells = F.array(F.col("a").bitwiseAND(F.lit(width - 1)), F.col("b").bitwiseAND(F.lit(width - 1)) + width)
    counts = found.select(F.explode(cells).alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    place = F.col("cell") + 1  # the bitmap functions count from one
    maps = counts.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(max(_BITMAP, 2 * width) // 8, dtype=np.uint8)
    for bucket, part in maps.collect():  # at most 2 * width / 32,768 rows of 4 KB
        start = (bucket - 1) * _BITMAP // 8
        piece = np.frombuffer(part, dtype=np.uint8)[: len(out) - start]
        out[start : start + len(piece)] = piece
    return out, bits


def screened(found: DataFrame) -> DataFrame:
    """`found` with `shared`: the depth up to which some other conversation may have the same prefix."""
    crowded, bits = crowded_cells(found)
    schema = T.StructType([found.schema["conv_id"], T.StructField("depth", T.LongType())])
    arrow, mask = to_arrow_schema(schema), (1 << bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def many(cells: np.ndarray) -> np.ndarray:
            return crowded[cells >> 3] >> (cells & 7).astype(np.uint8) & 1

        for batch in batches:
            a, b = (batch.column(i).to_numpy() & mask for i in (2, 3))
            alone = pa.array((many(a) & many(b + mask + 1)) == 0)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(alone) for i in (0, 1)], schema=arrow)

    proven = found.select("conv_id", F.col("depth").cast("long"), "a", "b").mapInArrow(run, schema)
    first = proven.groupBy("conv_id").agg((F.min("depth") - 1).alias("alone_after"))
    whole = found.join(first, "conv_id", "left").withColumn("shared", F.coalesce("alone_after", "size"))
    return written(whole.drop("alone_after"), "screened")


def member_digests(ends: DataFrame) -> DataFrame:
    """depth, a, b and ends_sha256, the digest of the ascending conv_ids of `ends` (depth, a, b, conv_id) joined by commas.

    Ids are joined in chunks of a bounded range first. A node with several chunks is hashed by one task in a stream
    over its chunks, since the digest itself has to go through all of them in turn.
    """
    key = ["depth", "a", "b"]
    chunks = ends.groupBy(*key, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    chunks = written(chunks, "member-chunks")
    sizes = chunks.groupBy(*key).agg(F.count("*").alias("n"), F.min("ids").alias("only"))
    short = sizes.where("n = 1").select(*key, F.sha2("only", 256).alias("ends_sha256"))
    long = chunks.join(sizes.where("n > 1").select(*key), key).select(*key, "chunk", "ids")
    schema = T.StructType([*(long.schema[c] for c in key), T.StructField("ends_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, state.hexdigest()), arrow)], schema=arrow)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    node = (row["depth"], row["a"], row["b"])
                    if node != now:
                        if now is not None:
                            yield told()
                        now, state = node, hashlib.sha256()
                    else:
                        state.update(b",")
                    state.update(row["ids"].encode())
        if now is not None:
            yield told()

    streamed = long.repartition(*key).sortWithinPartitions(*key, "chunk").mapInArrow(run, schema)
    return short.unionByName(streamed)


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the conversations, the empty one (root, depth 0) included.

    `turns` has conv_id, pos (from 1 without gaps), hashes a and b, and words; `convs` each conv_id once with its
    `size`, the turnless too. Returns conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null at
    the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256. Sums over subtrees are sums over members:
    a leaf and a node's words are each told by its smallest member, so no level has to wait for the next.
    No conversations: no rows.
    """
    convs = written(convs, "conversations")
    rows = screened(written(prefixes(turns, convs), "prefixes"))
    key, empty = ["depth", "a", "b"], F.sha2(F.lit(""), 256)
    shared, tails = rows.where("depth <= shared"), rows.where("depth > shared")

    nodes = shared.groupBy(*key).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("head"), F.sum((F.col("size") == F.col("depth")).cast("long")).alias("n_ends"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"),
    )
    nodes = written(nodes, "nodes")

    whole = (F.col("n_ends") == F.col("n_convs")) & (F.col("conv_id") == F.col("head"))
    leaf = F.when(F.col("depth") < F.col("shared"), F.lit(False)).when(F.col("shared") < F.col("size"), F.lit(True)).otherwise(whole)
    told = shared.join(nodes.select(*key, "n_convs", "n_ends", "head"), key).select(
        "conv_id", *key, "shared", leaf.cast("long").alias("leaves"), F.when(F.col("conv_id") != F.col("head"), F.col("words")).otherwise(0).cast("long").alias("saved")
    )
    told = running(told, F.col("shared") - F.col("depth"), ["leaves", "saved"], F.sum, lambda x, y: x + y)
    sums = told.groupBy(*key).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    up = (F.col("depth") - 1).alias("depth")
    first = tails.where("depth = shared + 1")
    born = nodes.select(up, F.col("pa").alias("a"), F.col("pb").alias("b")).unionAll(first.select(up, F.col("pa").alias("a"), F.col("pb").alias("b")))
    children = born.groupBy(*key).agg(F.count("*").alias("n_children"))

    ends = shared.where("depth = size").select(*key, "conv_id")
    none = convs.where("size = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv_id")
    members = written(member_digests(ends.unionByName(none)), "members")

    n_convs, root_id = convs.agg(F.count("*"), F.min("conv_id")).first()
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("head").alias("parent_conv_id"))
    above = F.when(F.col("depth") == 1, F.lit(root_id)).otherwise(F.col("parent_conv_id")).cast("long").alias("parent_conv_id")

    def given(frame: DataFrame, *columns: Column) -> DataFrame:
        names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
        return frame.select(*[c.cast("long").alias(n) for n, c in zip(names, columns)], columns[-1].alias("ends_sha256"))

    c, zero, one = F.col, F.lit(0), F.lit(1)
    full = nodes.join(sums, key).join(children, key, "left").join(members, key, "left").join(parents, ["depth", "pa", "pb"], "left")
    inner = given(full, c("head"), c("depth"), above, c("n_convs"), F.coalesce("n_children", zero), c("n_leaves"), c("saved_tokens"), F.coalesce("ends_sha256", empty))

    last = c("depth") == c("size")
    end = F.when(last, F.sha2(c("conv_id").cast("string"), 256)).otherwise(empty)
    alone = [one, F.when(last, zero).otherwise(one), one, zero, end]
    rest = given(tails.where("depth > shared + 1"), c("conv_id"), c("depth"), c("conv_id"), *alone)
    heads = given(first.join(parents, ["depth", "pa", "pb"], "left"), c("conv_id"), c("depth"), above, *alone)
    inner = written(inner.unionByName(heads), "inner-nodes")

    # The root has one row; what it sums up are the rows of depth 1.
    n_children, n_leaves, saved = inner.where("depth = 1").agg(F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    turnless = members.where("depth = 0").first()
    root = convs.sparkSession.range(1 if n_convs else 0)
    digest = F.lit(turnless["ends_sha256"]) if turnless else empty
    root = given(root, F.lit(root_id), zero, F.lit(None), *map(F.lit, (n_convs, n_children, n_leaves or 1, saved or 0)), digest)
    return root.unionByName(inner).unionByName(rest)


def lent(turns: DataFrame, every: int = LENDER_EVERY, most: int = MOST_LENT) -> tuple[DataFrame, DataFrame]:
    """Turns and sizes of conversations that each begin with some first turns of conversation c - c % `every`.

    Their number is the CRC-32 of the decimal c modulo `most`; the conversation's own first turns, as many, go.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    c = F.col("conv_id")
    sizes = sizes.withColumns({"h": F.crc32(c.cast("string").cast("binary")) % most, "lender": c - c % every})
    lenders = sizes.select(c.alias("lender"), F.col("own").alias("there"))
    convs = sizes.join(lenders, "lender", "left").withColumn("borrowed", F.least("h", F.coalesce("there", F.lit(0))))
    convs = convs.select("conv_id", "lender", "h", "borrowed", (F.col("borrowed") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"))
    convs = written(convs, "lent")
    first = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "lender")
    taken = convs.select("conv_id", "lender", "h").join(first, "lender").where(F.col("pos") <= F.col("h")).select("conv_id", "pos", "a", "b", "words")
    own = turns.join(convs.select("conv_id", "h", "borrowed"), "conv_id").where(F.col("pos") > F.col("h"))
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("borrowed")).alias("pos"), "a", "b", "words")
    return taken.unionByName(own), convs.select("conv_id", "size")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(numbered(table(spark, sf_dir, "conversations")), "numbered")
    return trie(*lent(turns))


#: The same rows from all prefixes as lists; for tables without equal turns in a conversation.
OP11_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, max(pos) AS own, conv_id - conv_id % 20 AS lender,
             xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
                 lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT) FOR k IN range(8)]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))),
                 4294967295) % 4 AS h
      FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.lender AND t.pos <= c.h
      UNION ALL
      SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.own, 0)), t.role, t.text
      FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN c b ON b.conv_id = c.lender WHERE t.pos > c.h),
w AS (SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS turns
      FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, len(turns) AS size, turns, unnest(range(len(turns) + 1)) AS depth FROM w),
m AS (SELECT conv_id, depth, size, turns, min(conv_id) OVER (PARTITION BY depth, turns[1:depth]) AS head FROM p),
n AS (SELECT depth, head, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = size), '')) AS ends_sha256,
             any_value(CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(turns[depth]['text'], '[^\\x20\\x09-\\x0D]+')) END) AS words
      FROM m GROUP BY depth, head),
up AS (SELECT n.*, m.head AS parent FROM n LEFT JOIN m ON m.conv_id = n.head AND m.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent AS head, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY ALL),
own AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (depth, head)),
sub AS (SELECT m.depth, m.head, sum(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((o.n_convs - 1) * o.words) AS saved
        FROM own o JOIN m ON m.conv_id = o.head AND m.depth <= o.depth GROUP BY m.depth, m.head)
SELECT head AS conv_id, depth, parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM own JOIN sub USING (depth, head)
"""
