"""Benchmark passages in documents: pigeonhole pieces of each item, exact hits, Myers bit-parallel checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.llm.common import ASCII_LOWER, blocks_of, map_texts, slices, table, written

#: Characters of an item per allowed edit: one edit in twenty.
CHARS_PER_EDIT = 20
#: Bytes of item text that one pass over the documents looks for; more items take more passes.
BLOCK_BYTES = 8 << 20

#: A-Z to a-z and ASCII white space to a blank; lengths stay, so places are those of the original text.
_FOLD = bytes(0x20 if b in b"\t\n\v\f\r" else b for b in ASCII_LOWER)

HITS = "item_id long, start int, end int, distance int"


def fold(text: bytes) -> str:
    return text.translate(_FOLD).decode("utf-8", "replace")


@dataclass
class Matcher:
    """An automaton over the pieces of all items of a block."""

    items: list[tuple[int, str]]
    automaton: object

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Matcher:
        items = [(i, t) for i, t in rows if t]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(items):
            cuts = len(item) // CHARS_PER_EDIT + 1
            edges = [len(item) * c // cuts for c in range(cuts + 1)]
            for a, b in zip(edges, edges[1:]):
                pieces.setdefault(item[a:b], []).append((n, a))
        automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            automaton.add_word(piece, (len(piece), places))
        if pieces:
            automaton.make_automaton()
        return cls(items, automaton if pieces else None)

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) of every place within an item's budget, by item and start.

        Of places that touch, the closest is told, the first of several alike.
        """
        if self.automaton is None or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        exact: dict[int, list[tuple[int, int]]] = {}
        for last, (length, places) in self.automaton.iter(text):
            for n, offset in places:
                item = self.items[n][1]
                size, budget = len(item), len(item) // CHARS_PER_EDIT
                begin = last + 1 - length - offset
                found = exact.get(n)
                if found and found[-1][0] <= begin < found[-1][1]:
                    continue
                if text.startswith(item, begin) if begin >= 0 else False:
                    exact.setdefault(n, []).append((begin, begin + size))
                    continue
                a, b = max(0, begin - budget), min(len(text), begin + size + budget)
                mine = windows.setdefault(n, [])
                if mine and a <= mine[-1][1] and b >= mine[-1][0]:
                    mine[-1] = [min(a, mine[-1][0]), max(b, mine[-1][1])]
                else:
                    mine.append([a, b])
        out = []
        for n in sorted(windows.keys() | exact.keys()):
            number, item = self.items[n]
            sure = exact.get(n, [])
            places = [(a, b, 0) for a, b in sure]
            for a, b in _merged(windows.get(n, [])):
                for s, e, d in occurrences(item, text[a:b], len(item) // CHARS_PER_EDIT):
                    if not any(x < a + e and a + s < y for x, y in sure):
                        places.append((a + s, a + e, d))
            out += [(number, *p) for p in sorted(set(places))]
        return out


def _merged(windows: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def end_distances(pattern: str, text: str, anchored: bool = False) -> list[int]:
    """Least edit distance of the pattern to a part of the text that ends after each character.

    Myers' bit vectors, one big integer per column of the dynamic program. `anchored`: the part must begin
    at the text's start.
    """
    size = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << size - 1
    up, down, score, out = full, 0, size, []
    for c in text:
        match = masks.get(c, 0)
        zero = (((match & up) + up) ^ up) | match | down
        more, less = down | (full & ~(zero | up)), up & zero
        score += bool(more & top) - bool(less & top)
        more = (more << 1) | anchored
        up = ((less << 1) | (full & ~(zero | more))) & full
        down = more & zero & full
        out.append(score)
    return out


def occurrences(pattern: str, text: str, budget: int) -> list[tuple[int, int, int]]:
    """(start, end, distance) of the best place of each run of touching matches within the budget."""
    ends = [(e + 1, d) for e, d in enumerate(end_distances(pattern, text)) if d <= budget]
    places: list[tuple[int, int, int]] = []
    for end, distance in ends:
        back = text[max(0, end - len(pattern) - budget) : end][::-1]
        lengths = end_distances(pattern[::-1], back, True)
        if distance >= len(pattern):
            continue
        start = end - 1 - lengths.index(distance) if distance in lengths else end
        if places and start < places[-1][1]:
            if distance < places[-1][2]:
                places[-1] = (start, end, distance)
        else:
            places.append((start, end, distance))
    return places


def item_blocks(items: DataFrame, named: bool, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about BLOCK_BYTES, one at a time; null and empty texts go, and null ids if `named`."""
    frame = items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t <> ''").distinct()
    for rows in blocks_of(frame.where("i is not null") if named else frame, F.octet_length("t"), BLOCK_BYTES):
        yield sorted(((r["i"], fold(r["t"].encode())) for r in rows), key=lambda x: (x[0] is None, x))


def find_items(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep`, item_id, start, end (code points, end exclusive) and distance of each benchmark passage.

    Whole texts are searched for every item with one edit allowed per CHARS_PER_EDIT characters, after
    folding A-Z and white space. With k edits allowed an item is cut into k+1 pieces, one of which a match
    must hold unchanged, so no match is lost. Null texts count as empty; empty items match nowhere, items without
    an id cannot be told and are not searched; repeated rows of either table are searched alike; rows of one item
    id with several texts are all searched. The items are searched in blocks, a pass over the documents each, and
    only a block at a time is held anywhere.
    """
    found = None
    for block in item_blocks(items, True):
        def worker(block=block):
            matcher = Matcher.of(block)
            return lambda texts: [[matcher.search(fold(t)) for t in texts]]

        part = map_texts(docs, keep, f"hits array<struct<{HITS.replace(' ', ':')}>>".replace(",:", ","), worker, text)
        part = part.where(F.size("hits") > 0).select(*keep, F.inline("hits"))
        found = part if found is None else found.unionByName(written(part, "hits"))
    return found


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, that hold no benchmark passage, items without an id included."""
    position = docs.columns.index(text)
    clean = docs
    for number, block in enumerate(item_blocks(items, False)):
        def run(batches, block=block):
            matcher = Matcher.of(block)
            for batch in batches:
                for piece in slices(batch, position):
                    texts = piece.column(position).cast(pa.binary()).to_pylist()
                    yield piece.filter(pa.array([not matcher.search(fold(t or b"")) for t in texts], type=pa.bool_()))

        clean = (written(clean, "clean") if number else clean).mapInArrow(run, docs.schema)
    return clean


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return find_items(docs, items, ["doc_id"])
