"""Near duplicates by SimHash: segment popcounts, a grid range join under Manhattan distance, exact checks.

The pipeline's stage also links texts by the exact likeness of their shingle sets.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from storeops.llm.common import ASCII_LOWER, map_texts, scratch, slices, table, written
from storeops.llm.graph import components

#: The query: words of a shingle; differing bits that still link.
SHINGLE, RADIUS = 3, 2
#: The 64 bits are cut into segments of four; each holds 0 to 4 set bits, so a cell is a number in base 5.
SEGMENTS, SEGMENT_BITS = 16, 4
#: Cells with more fingerprints are refined into one-bit segments instead of being compared pair by pair.
CROWDED = 64
#: Shingles whose bits are counted at a time, which bounds memory for very long texts.
BLOCK = 1 << 15
#: The pipeline's stage: words of a shingle, and the Jaccard likeness of shingle sets that links, as a fraction.
STAGE_SHINGLE = 5
LIKE, OF = 4, 5
#: About so many texts tell which shingles are common, those that COMMON of them hold; at most MOST_COMMON of them.
SAMPLE, COMMON, MOST_COMMON = 4096, 3, 1 << 18
#: Bits of a shingle's hash that name its slot in the table of counts; 2 ** 28 slots travel as 32 MB of bits. Parts of the table.
LEAST_SLOT_BITS, MOST_SLOT_BITS, PART_BITS = 16, 28, 8
#: The smallest sets of a cell, with which all its sets are compared before any others are.
LEADERS = 32
#: So many of a set's cells that are larger than that tell where two sets meet first.
FIRST_CELLS = 16
#: Slots that a task counts before it hands them on; times that crowded shingles are put last and all is counted anew.
FLUSH, ROUNDS = 1 << 20, 2
#: Bits of the classes that a set's shingles are counted in, before texts are shuffled to compare them.
LEAST_CLASS_BITS, MOST_CLASS_BITS = 5, 14


def fingerprint_of(text: bytes, width: int = SHINGLE) -> int:
    """Majority of the bits of all shingle hashes, repeats included; zero for a text without words."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return 0
    count = max(1, len(words) - width + 1)
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, count, BLOCK):
        end = min(count, start + BLOCK)
        rows = [words[start + k : end + k] for k in range(width)]
        joined = map(b" ".join, zip(*rows)) if len(words) >= width else [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(x, 42) for x in joined], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = SHINGLE) -> DataFrame:
    """`keep` and the fingerprint `fp` (bits of a long) of each whole text. Null texts count as empty."""

    def worker():
        return lambda texts: [[fingerprint_of(t, width) for t in texts]]

    return map_texts(docs, keep, "fp long", worker, text)


class _WordHashes(dict):
    """XXH64 of words, remembered; forgotten all at once when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 19:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value


_HASH_OF_WORD = _WordHashes()


def shingle_set(text: bytes, width: int = STAGE_SHINGLE) -> np.ndarray:
    """The distinct shingle hashes in ascending order; a shorter text is one shingle, one without words has none.

    A shingle's 64-bit hash is mixed from those of its words in their order.
    """
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    each = np.fromiter(map(_HASH_OF_WORD.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    mixed = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        mixed = (mixed ^ each[k : len(each) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) ^ (mixed >> np.uint64(32))
    return np.unique(mixed.view(np.int64))


@dataclass
class Order:
    """The order in which all sets tell their shingles: by weight, then by hash. Common shingles weigh most.

    Weights come from shingles that a sample holds often and from crowded slots of the table. They are the same for
    all sets, so no pair depends on them; they only decide how many sets share a cell.
    """

    keys: np.ndarray
    counts: np.ndarray
    bits: int = LEAST_SLOT_BITS
    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    crowds: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def slot_of(self, shingles: np.ndarray) -> np.ndarray:
        return shingles & ((1 << self.bits) - 1)

    def rarest(self, shingles: np.ndarray) -> np.ndarray:
        """The first shingles of an ascending set, so many that two sets of likeness LIKE / OF or more share one.

        Each of two such sets holds all but OF - LIKE of OF parts of the other.
        """
        weight = np.maximum(_looked_up(self.keys, self.counts, shingles), _looked_up(self.slots, self.crowds, self.slot_of(shingles)))
        order, size = np.lexsort((shingles, weight)), len(shingles)
        return shingles[order[: size - -(-LIKE * size // OF) + 1 if size else 0]]

    def with_crowds(self, slots: np.ndarray, crowds: np.ndarray) -> Order:
        """More crowded slots; of all the MOST_COMMON with the greatest counts."""
        every = dict(zip(self.slots.tolist(), self.crowds.tolist())) | dict(zip(slots.tolist(), crowds.tolist()))
        rows = sorted(sorted(every.items(), key=lambda x: (-x[1], x[0]))[:MOST_COMMON])
        return replace(self, slots=np.array([r[0] for r in rows], np.int64), crowds=np.array([r[1] for r in rows], np.int64))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key, 0 where it is not among the ascending keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def common_shingles(docs: DataFrame, text: str = "text") -> Order:
    """The order by what a sample of the texts has in common."""
    part = max(1, docs.count() // SAMPLE)
    sample = docs.select(F.col(text).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(part)) == 0).distinct()

    def worker():
        return lambda texts: [[shingle_set(t) for t in texts]]

    sets = map_texts(sample, [], "shingles array<long>", worker)
    counts = sets.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    rows = sorted(tuple(r) for r in counts.orderBy(F.col("n").desc(), "s").limit(MOST_COMMON).collect())
    return Order(np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64))


def set_id(shingles: np.ndarray) -> int:
    """A hash of a whole set, 0 for the empty one."""
    return xxhash.xxh64_intdigest(shingles.tobytes(), 42) - (1 << 63) if len(shingles) else 0


def stage_prints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep`, the fingerprint `fp`, and of the set of shingles a hash `sid` and the size `n`."""

    def worker():
        def run(texts: list[bytes]) -> list:
            sets = [shingle_set(t) for t in texts]
            return [[fingerprint_of(t) for t in texts], [set_id(s) for s in sets], [len(s) for s in sets]]

        return run

    return map_texts(docs, keep, "fp long, sid long, n int", worker, text)


def tally(shingles: np.ndarray) -> bytes:
    """How many shingles of a set fall into each class, a byte per class; 255 stands for as many or more.

    Classes are the low bits of the hash. There are so many that each has four shingles or fewer on average, up to
    a set of 2 ** (MOST_CLASS_BITS + 2).
    """
    bits = min(MOST_CLASS_BITS, max(LEAST_CLASS_BITS, (len(shingles) // 4).bit_length()))
    counts = np.bincount(shingles & ((1 << bits) - 1), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def may_be_alike(left: bytes, right: bytes) -> bool:
    """Whether sets with these tallies can have a likeness of LIKE / OF; never False for sets that have it.

    In each class two sets have at most the lesser count in common. The finer tally is summed to the coarser one's
    classes. Where a class is full nothing is said.
    """
    a, b = sorted((np.frombuffer(x, np.uint8) for x in (left, right)), key=len)
    if a.max() == 255 or b.max() == 255:
        return True
    b = b.reshape(-1, len(a)).sum(axis=0)
    return int(np.minimum(a, b).sum()) * (LIKE + OF) >= int(a.sum() + b.sum()) * LIKE


def slot_counts(texts: DataFrame, order: Order) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bit for each slot that rare shingles of two or more texts fall into; the crowded slots and their counts.

    Tasks sort the slots they meet and hand them on as compressed differences, a row per part of the table; the
    parts are counted one after the other. A text that repeats in a stretch of a task counts once there. Slots that
    several cells share only keep more than needed.
    """
    width = order.bits - PART_BITS
    frame = texts.select("text")
    packed = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("slots", T.BinaryType())])
    summed = T.StructType([packed["part"], T.StructField("bits", T.BinaryType()), T.StructField("slots", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    to_packed, to_summed = to_arrow_schema(packed), to_arrow_schema(summed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def flushed() -> pa.RecordBatch:
            slots = np.sort(np.concatenate(held))
            edges = np.searchsorted(slots, np.arange((1 << PART_BITS) + 1) << width)
            some = np.flatnonzero(np.diff(edges))
            data = [zlib.compress(np.diff(slots[edges[p] : edges[p + 1]], prepend=p << width).astype("<u4").tobytes(), 1) for p in some.tolist()]
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(data, pa.binary())], schema=to_packed)

        for batch in batches:
            for piece in slices(batch, 0):
                for value in piece.column(0).cast(pa.binary()).to_pylist():
                    shingles = shingle_set(value or b"")
                    sid = set_id(shingles)
                    if len(shingles) and sid not in seen:
                        seen.add(sid)
                        held.append(order.slot_of(order.rarest(shingles)))
                        size += len(held[-1])
                    if size >= FLUSH:
                        yield flushed()
                        held, size, seen = [], 0, set()
        if held:
            yield flushed()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, None

        def told() -> pa.RecordBatch:
            crowded = np.flatnonzero(counts > CROWDED)
            columns = [[now], [np.packbits(counts > 1, bitorder="little").tobytes()], [crowded + (now << width)], [counts[crowded].astype(np.int64)]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, to_summed)], schema=to_summed)

        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != now:
                    if now is not None:
                        yield told()
                    now, counts = part, np.zeros(1 << width, np.int64)
                places = np.cumsum(np.frombuffer(zlib.decompress(data.as_py()), "<u4"), dtype=np.int64)
                np.add.at(counts, places, 1)
        if now is not None:
            yield told()

    parts = frame.mapInArrow(count, packed).repartition("part").sortWithinPartitions("part").mapInArrow(add, summed)
    bits, slots, crowds = np.zeros((1 << order.bits) // 8, np.uint8), [], []
    for row in parts.collect():  # 2 ** PART_BITS rows with all bits of the table, and no more crowded slots than shared ones
        start = (row["part"] << width) // 8
        bits[start : start + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
        slots += row["slots"]
        crowds += row["counts"]
    return bits, np.array(slots, np.int64), np.array(crowds, np.int64)


def shared_cells(texts: DataFrame, prefix_size: int) -> tuple[DataFrame, DataFrame]:
    """cell, its size m, and x (sid, n, pos): rare shingles of each distinct set that other sets have among theirs.

    Beside them (sid, tally) of these sets.

    Crowded slots are put last in the order, and all is counted anew, until there are no new ones or ROUNDS are over.
    What stays crowded then are texts without rarer shingles, as groups of near copies.
    """
    bits = min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, math.ceil(math.log2(4 * max(1, prefix_size)))))
    order = replace(common_shingles(texts), bits=bits)
    for last in range(ROUNDS):
        table_bits, slots, crowds = slot_counts(texts, order)
        fresh = ~np.isin(slots, order.slots)
        if last == ROUNDS - 1 or not fresh.any():
            break
        order = order.with_crowds(slots[fresh], crowds[fresh])

    def worker():
        def run(batch: list[bytes]) -> list:
            sids, sizes, cells, places, tallies = [], [], [], [], []
            for text in batch:
                shingles = shingle_set(text)
                rare = order.rarest(shingles)
                slot = order.slot_of(rare)
                kept = np.flatnonzero(table_bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                sids.append(set_id(shingles))
                sizes.append(len(shingles))
                cells.append(rare[kept])
                places.append(kept)
                tallies.append(tally(shingles) if len(kept) else None)
            return [sids, sizes, cells, places, tallies]

        return run

    rows = map_texts(texts, [], "sid long, n int, cells array<long>, places array<int>, tally binary", worker)
    rows = written(rows.where(F.size("cells") > 0).dropDuplicates(["sid"]), "rare-cells")
    cells = rows.select("sid", "n", F.explode(F.arrays_zip("cells", "places")).alias("c"))
    cells = cells.select(F.col("c.cells").alias("cell"), F.struct("sid", "n", F.col("c.places").alias("pos")).alias("x"))
    sizes = cells.groupBy("cell").agg(F.count("*").alias("m")).where("m > 1")
    return written(cells.join(sizes, "cell"), "shared-cells"), rows.select("sid", "tally")


def grid_cells(classes: DataFrame) -> DataFrame:
    """(fp, cell, tag): each fingerprint's own cell (tag 0) and the up to 32 cells one step away.

    A bit flip changes one segment's popcount by one, so two fingerprints at Hamming distance 2 or less lie
    within Manhattan distance 2, and then some cell is at most one step from both.
    """
    counts = [F.bit_count(F.shiftrightunsigned("fp", SEGMENT_BITS * s).bitwiseAND(F.lit(2**SEGMENT_BITS - 1))) for s in range(SEGMENTS)]
    frame = classes.select("fp", *[c.cast("long").alias(f"p{s}") for s, c in enumerate(counts)])
    base = SEGMENT_BITS + 1
    own = sum((F.col(f"p{s}") * base**s for s in range(SEGMENTS)), F.lit(0).cast("long"))
    frame = frame.withColumn("own", own)

    def cell(number, tag):
        return F.struct(number.alias("cell"), F.lit(tag).alias("tag"))

    steps = [cell(F.col("own"), 0)]
    for s in range(SEGMENTS):
        steps.append(F.when(F.col(f"p{s}") < SEGMENT_BITS, cell(F.col("own") + base**s, 2 * s + 1)))
        steps.append(F.when(F.col(f"p{s}") > 0, cell(F.col("own") - base**s, 2 * s + 2)))
    return frame.select("fp", F.explode(F.array(*steps)).alias("c")).where("c is not null").select("fp", "c.cell", "c.tag")


def links(classes: DataFrame) -> DataFrame:
    """(a, b): pairs of different fingerprints at Hamming distance 2 or less, enough to connect all of them.

    Cells that several fingerprints share are joined, and each candidate is checked on its exact distance; of
    the cells a pair shares, the tags single out one. A crowded cell, as a large group of near copies makes,
    is cut into one-bit segments: there a shared cell proves the distance, so every member is linked to the
    smallest one and the work stays linear. No pair is lost either way.
    """
    cells = grid_cells(classes)
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(cells.join(sizes, "cell"), "cells")
    sparse = shared.where(F.col("n") <= CROWDED)
    a = sparse.select("cell", F.col("fp").alias("a"), F.col("tag").alias("ta"))
    b = sparse.select("cell", F.col("fp").alias("b"), F.col("tag").alias("tb"))
    once = F.expr("ta = 0 or (tb > 0 and ta <> tb and (ta + 1) div 2 <= (tb + 1) div 2)")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    pairs = a.join(b, "cell").where((F.col("a") < F.col("b")) & once & near).select("a", "b")

    dense = shared.where(F.col("n") > CROWDED).select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)])
    fine = written(dense.select("fp", F.explode(flips).alias("cell")), "fine-cells")
    stars = fine.groupBy("cell").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    starred = fine.join(stars, "cell").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(starred.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).distinct())


def component_ids(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """(fp, component_id) for each distinct fingerprint: the smallest `key` reachable over links.

    `prints` has `key` and `fp`, one row per document, and should be a written table. Rows of one fingerprint
    are one node, so copies cost nothing. Null keys never are a component_id unless there is no other.
    """
    classes = written(prints.groupBy("fp").agg(F.min(key).alias("first")), "classes")
    roots = written(components(links(classes)), "roots")
    grouped = roots.join(classes, roots["node"] == classes["fp"]).select("fp", "root", "first")
    lowest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = grouped.join(lowest, "root").select("fp", "component_id")
    return written(
        classes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")),
        "components",
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row of `docs`.

    Fingerprints of any two documents that differ in 2 or fewer bits link them; component_id is the smallest
    doc_id reachable. Null and blank texts have fingerprint zero and link like any other. A row with a null
    doc_id is fingerprinted and linked, but lends its id to nobody; its component_id is null if all its
    fellows lack ids. Repeated rows each get their row. Other columns are not read. No rows: no rows.
    """
    prints = written(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ["doc_id"]), "simhash")
    return prints.join(component_ids(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def alike(sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): sids of pairs of `sets` of likeness LIKE / OF or more, enough to connect all of them.

    `sets` has sid, n and _row_key, one row per set; `texts` has _row_key and text. Sets that share a rare shingle
    are compared if their sizes and the places of the shingle leave room for enough common ones (Xiao and others,
    2008): by their tallies, and if these leave room too, on all shingles. First each set of a cell is compared with the LEADERS smallest ones, which are all of most
    cells. In larger cells the links found so far connect groups of near copies. Only sets outside of a cell's greatest
    such group meet the rest of the cell, and only those that no links connect are compared. Of the larger cells that
    two sets share the first in the order counts; where it is not among the FIRST_CELLS of both, all do.
    """
    size = sets.agg(F.sum(F.col("n") - F.ceil(F.col("n") * LIKE / OF) + 1)).first()[0] or 0
    shared, tallies = shared_cells(texts.select("text"), size)
    a, b = F.col("a"), F.col("b")
    near = F.least(a["n"], b["n"]) * OF >= F.greatest(a["n"], b["n"]) * LIKE
    fits = near & (F.least(a["n"] - a["pos"], b["n"] - b["pos"]) * (LIKE + OF) >= (a["n"] + b["n"]) * LIKE)

    def pairs(frame: DataFrame) -> DataFrame:
        return frame.where(fits).select(F.least("a.sid", "b.sid").alias("a"), F.greatest("a.sid", "b.sid").alias("b")).distinct()

    place = F.row_number().over(Window.partitionBy("cell").orderBy("x.sid"))
    leaders = shared.withColumn("place", place).where(F.col("place") <= LEADERS).select("cell", F.col("x").alias("a"))
    leaders = written(leaders, "leaders")
    first = leaders.join(shared.select("cell", F.col("x").alias("b")), "cell").where("a.sid < b.sid")
    found = checked(possible(pairs(first), tallies), sets, texts)

    last = leaders.groupBy("cell").agg(F.max("a.sid").alias("last"))
    large = shared.where(F.col("m") > LEADERS).select("cell", "x", "x.sid")
    heads = large.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("x.pos", "cell"))).alias("s"))
    heads = heads.select("sid", F.slice("s.cell", 1, FIRST_CELLS).alias("heads"))
    roots = components(found).select(F.col("node").alias("sid"), "root")
    rest = large.join(last, "cell").where("sid > last").join(heads, "sid").join(roots, "sid", "left")
    rest = written(rest.select("cell", "x", "heads", F.coalesce("root", "sid").alias("root")), "crowded")
    groups = rest.groupBy("cell", "root").agg(F.count("*").alias("size"))
    main = groups.groupBy("cell").agg(F.max_by("root", F.struct("size", "root")).alias("main"))
    sides = rest.join(main, "cell").select("cell", "x", "heads", "root", (F.col("root") == F.col("main")).alias("inner"))
    sides = written(sides, "sides")
    outer = sides.where("not inner").select("cell", F.col("x").alias("a"), F.col("heads").alias("heads_a"), F.col("root").alias("root_a"))
    whole = sides.select("cell", F.col("x").alias("b"), F.col("heads").alias("heads_b"), F.col("root").alias("root_b"), "inner")
    both = outer.join(whole, "cell").where("root_a <> root_b and (inner or a.sid < b.sid)")
    both = both.where("coalesce(get(array_intersect(heads_a, heads_b), 0), cell) = cell")
    return found.union(checked(possible(pairs(both), tallies), sets, texts))


def possible(pairs: DataFrame, tallies: DataFrame) -> DataFrame:
    """The pairs (a, b) of sids that may be alike by their tallies."""
    schema = pairs.schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 2):
                keep = [may_be_alike(x, y) for x, y in zip(piece.column(2).to_pylist(), piece.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(piece.filter(pa.array(keep, pa.bool_())).columns[:2], schema=arrow)

    sides = [tallies.select(F.col("sid").alias(s), F.col("tally").alias(f"tally_{s}")) for s in "ab"]
    both = pairs.join(sides[1], "b").join(sides[0], "a").select("a", "b", "tally_a", "tally_b")
    return both.mapInArrow(run, schema)


def checked(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of sids whose whole shingle sets are alike.

    Only texts whose key has its bit among those of the pairs are shuffled; a pair then meets both of its texts.
    """
    pairs = written(pairs, "candidates")
    nodes = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    nodes = written(sets.select("sid", "_row_key").join(nodes, "sid"), "nodes")
    whole = holding(texts, nodes).join(nodes, "_row_key").dropDuplicates(["sid"])
    whole = written(whole.select("sid", "text"), "node-texts")
    sides = [whole.select(F.col("sid").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab"]
    schema = pairs.schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            for piece in slices(batch, 2):
                keep = []
                for first, x, y in zip(piece.column(0).to_pylist(), piece.column(2), piece.column(3)):
                    if first != last:
                        last, left = first, shingle_set((x.as_py() or "").encode())
                    right = shingle_set((y.as_py() or "").encode())
                    common = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(common * (LIKE + OF) >= (len(left) + len(right)) * LIKE)
                piece = piece.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays(piece.columns[:2], schema=arrow)

    both = pairs.join(sides[1], "b").join(sides[0], "a").select("a", "b", "text_a", "text_b")
    return written(both.mapInArrow(run, schema), "alike")


def holding(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of `texts` whose _row_key falls on a bit that some key of `nodes` sets; few others come along."""
    bits = min(MOST_SLOT_BITS - 2, max(LEAST_SLOT_BITS, math.ceil(math.log2(16 * max(1, nodes.count())))))
    place = F.xxhash64("_row_key").bitwiseAND(F.lit((1 << bits) - 1))
    spot = place + 1  # the bitmap functions count from one
    maps = nodes.groupBy(F.bitmap_bucket_number(spot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for bucket, part in maps.collect():  # at most 2 ** bits / 32,768 rows of 4 KB
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(part, np.uint8)
    frame = texts.select("_row_key", "text", place.alias("_place"))
    schema = frame.drop("_place").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            kept = batch.filter(pa.array((out[at >> 3] >> (at & 7).astype(np.uint8) & 1) == 1))
            yield pa.RecordBatch.from_arrays(kept.columns[:2], schema=to_arrow_schema(schema))

    return frame.mapInArrow(run, schema)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of near duplicates, all columns as they are.

    Two texts are linked if their fingerprints differ in RADIUS or fewer bits (by the popcount grid), or if their
    sets of STAGE_SHINGLE words have a Jaccard likeness of LIKE / OF or more (by rare shingles). The row with the
    smallest doc_id stays (null ids come last; of rows that share an id, the one whose text has the smallest hash, and
    of those equal in both, the one whose whole row has). Equal sets are one node of the graph. Tables made on the way
    are deleted at the end.
    """
    key = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.hex(F.xxhash64(text)))
    keyed = docs.select(key.alias("_row_key"), F.struct(*docs.columns).alias("_whole"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), key.alias("_row_key"), F.col(text).alias("text"))
    with scratch(docs.sparkSession):
        kept = _kept_keys(texts)
    one = Window.partitionBy("_row_key").orderBy(F.xxhash64("_whole"))
    stay = keyed.join(kept, "_row_key", "left_semi").withColumn("_copy", F.row_number().over(one))
    return stay.where("_copy = 1").select("_whole.*")


def _kept_keys(texts: DataFrame) -> DataFrame:
    """The _row_key of the first row of each component of `texts` (doc_id, _row_key, text)."""
    prints = written(stage_prints(texts, ["doc_id", "_row_key"]), "simhash")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row_key")
    sets = prints.groupBy("sid").agg(F.min(rank).alias("first"), F.first("n").alias("n"))
    sets = written(sets.select("sid", "first", "n", F.col("first._row_key").alias("_row_key")), "sets")
    members = prints.select("fp", "sid").distinct()
    classes = written(members.groupBy("fp").agg(F.min("sid").alias("head")), "classes")
    same = members.join(classes, "fp").where("sid <> head").select(F.col("head").alias("a"), F.col("sid").alias("b"))
    ends = links(classes).join(classes.select(F.col("fp").alias("a"), F.col("head").alias("_a")), "a")
    ends = ends.join(classes.select(F.col("fp").alias("b"), F.col("head").alias("_b")), "b").select("_a", "_b")
    edges = same.union(ends).union(alike(sets, texts.select("_row_key", "text")))
    roots = written(components(edges), "roots")
    whole = sets.join(roots, sets["sid"] == roots["node"], "left")
    kept = whole.groupBy(F.coalesce("root", "sid").alias("root")).agg(F.min("first").alias("first"))
    return written(kept.select(F.col("first._row_key").alias("_row_key")), "kept", lasting=True)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
