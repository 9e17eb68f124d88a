"""Byte-level BPE: pre-tokenisation by a scan of transition functions, cached merges, decoding by offsets."""

from __future__ import annotations

import base64
import heapq
import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.llm.common import SLICE, map_texts, table

#: Classes of code points; symbols are classes, and an apostrophe that a contraction's letters follow.
LETTER, NUMBER, OTHER, BLANK, SPACE, BREAK, SHORT, LONG = range(8)
#: States: what the token in progress is. SHORT_1 and LONG_n still need n letters of a contraction, DONE none.
START, IN_LETTER, IN_NUMBER, IN_OTHER, IN_BLANK, IN_SPACE, NEED_1, NEED_2, DONE = range(9)
STATES = 9

#: Contractions of the published pattern, without the apostrophe.
SHORT_ENDS, LONG_ENDS = "stmd", ("re", "ve", "ll")

#: Merged slices that a task remembers, besides those of the texts at hand.
REMEMBERED = 1 << 17

#: Longer slices (bytes) are merged one by one.
LONG_PIECE = 64
#: The rank of a pair that is no token.
NONE = np.int32(2**31 - 1)


def code_point_classes() -> bytes:
    """The class of every code point as the tokenizer library's own regular expressions have it.

    The library is asked once per class which code points match; the answer is packed for the tasks.
    """
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, every))
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    ranks = {bytes([b]): b for b in range(256)}
    for number, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found = probe.decode_bytes(probe.encode_ordinary(text)).decode("utf-8")
        classes[np.frombuffer(found.encode("utf-32-le"), dtype="<u4")] = number
    classes[0x20] = BLANK
    return zlib.compress(classes.tobytes(), 9)


def _transition(symbol: int, state: int) -> int:
    """The state after a symbol. `SHORT` and `LONG` open a contraction unless the apostrophe joins a run."""
    if symbol == LETTER:
        return {NEED_2: NEED_1, NEED_1: DONE}.get(state, IN_LETTER)
    if symbol in (SHORT, LONG):
        if state in (IN_OTHER, IN_BLANK):
            return IN_OTHER
        return NEED_1 if symbol == SHORT else NEED_2
    return {NUMBER: IN_NUMBER, OTHER: IN_OTHER, BLANK: IN_BLANK, SPACE: IN_SPACE, BREAK: START}[symbol]


def _closure() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the symbols' transition functions: their effects, symbols' numbers, products."""
    functions = [tuple(_transition(s, q) for q in range(STATES)) for s in range(8)]
    known = {f: i for i, f in enumerate(dict.fromkeys(functions))}
    first = [known[f] for f in functions]
    queue = list(known)
    while queue:
        f = queue.pop()
        for g in list(known):
            for h in (tuple(g[q] for q in f), tuple(f[q] for q in g)):
                if h not in known:
                    known[h] = len(known)
                    queue.append(h)
    order = list(known)
    product = np.array([[known[tuple(g[q] for q in f)] for g in order] for f in order], dtype=np.uint8)
    return np.array(order, dtype=np.uint8), np.array(first, dtype=np.uint8), product


EFFECT, NUMBER_OF, PRODUCT = _closure()
SIZE = np.uint8(len(EFFECT))  # few enough that a pair's number fits a byte
_EFFECT, _PRODUCT = EFFECT.ravel(), PRODUCT.ravel()


def _opens() -> np.ndarray:
    """Whether a symbol opens a token after a state; a space after a space is settled by what follows it."""
    table = np.zeros((STATES, 8), dtype=bool)
    for state in range(STATES):
        table[state, LETTER] = state not in (IN_LETTER, NEED_1, NEED_2, IN_BLANK)
        table[state, NUMBER] = state not in (IN_NUMBER, IN_BLANK)
        table[state, [OTHER, SHORT, LONG]] = state not in (IN_OTHER, IN_BLANK)
        table[state, [BLANK, SPACE]] = state not in (IN_BLANK, IN_SPACE)
        table[state, BREAK] = True
    return table


OPENS = _opens()


def states_before(symbols: np.ndarray) -> np.ndarray:
    """The state before each symbol, from an associative scan of the transition functions.

    The row of symbols is cut into strips that are composed side by side, column by column; the strips'
    totals are scanned in turn, and each strip is then entered in its right state.
    """
    size = len(symbols)
    width = max(1, int(size**0.5))
    rows = -(-size // width)
    padded = np.full(rows * width, BREAK, dtype=np.uint8)
    padded[:size] = symbols
    grid = np.ascontiguousarray(NUMBER_OF[padded].reshape(rows, width).T)
    for column in range(1, width):
        np.take(_PRODUCT, grid[column - 1] * SIZE + grid[column], out=grid[column])
    entry = np.empty(rows, dtype=np.uint8)
    state = START
    for row, total in enumerate(grid[-1].tolist()):
        entry[row] = state
        state = EFFECT[total, state]
    before = np.empty((width, rows), dtype=np.uint8)
    before[0] = entry
    if width > 1:
        np.take(_EFFECT, grid[:-1] * np.uint8(STATES) + entry, out=before[1:])
    return before.T.reshape(-1)[:size]


def boundaries(text: str, points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where tokens start in a row of texts, given its code points and their classes; a BREAK ends each text."""
    symbols = classes.copy()
    for i in np.flatnonzero((points == 0x27) & (classes == OTHER)).tolist():
        ending = text[i + 1 : i + 3]
        if ending[:1] and ending[0] in SHORT_ENDS:
            symbols[i] = SHORT
        elif ending in LONG_ENDS:
            symbols[i] = LONG
    before = states_before(symbols)
    opens = OPENS[before, symbols]
    # The last of several spaces goes with what follows, or stands alone; a text's last spaces stay together.
    space = (symbols == BLANK) | (symbols == SPACE)
    later = np.empty(len(symbols), dtype=bool)
    later[:-1] = ~space[1:] & (symbols[1:] != BREAK)
    later[-1:] = False
    opens |= space & later
    return opens


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    """A place in a table of `size` (a power of two) for each key."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(65 - int(size).bit_length())).astype(np.int64)


@dataclass
class Codec:
    """Encoder and decoder of one rank file."""

    ranks: dict[bytes, int]
    classes: np.ndarray

    @classmethod
    def of(cls, rank_file: bytes, packed_classes: bytes) -> Codec:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        codec = cls(ranks, np.frombuffer(zlib.decompress(packed_classes), dtype=np.uint8))
        codec.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            codec.tokens[rank] = piece
        codec.lengths = np.array([len(t) for t in codec.tokens], dtype=np.int64)
        codec.begins = np.cumsum(codec.lengths) - codec.lengths
        codec.bytes = np.frombuffer(b"".join(codec.tokens), dtype=np.uint8)
        codec.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = sorted(
            (ranks[piece[:i]] << 32 | ranks[piece[i:]], rank)
            for piece, rank in ranks.items()
            for i in range(1, len(piece))
            if piece[:i] in ranks and piece[i:] in ranks
        )
        keys, numbers = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        size = 1 << max(8, (4 * len(keys)).bit_length())
        slots, first = np.unique(_slot(keys, size), return_index=True)
        codec.slot_keys, codec.slot_ranks = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        codec.slot_keys[slots], codec.slot_ranks[slots] = keys[first], numbers[first]
        rest = np.setdiff1d(np.arange(len(keys)), first)  # pairs whose slot another one holds
        codec.spilled, codec.spilled_ranks = keys[rest], numbers[rest].astype(np.int32)
        return cls.from_state(vars(codec))

    @classmethod
    def from_state(cls, state: dict) -> Codec:
        """A codec of the given tables that has learnt nothing yet."""
        codec = cls.__new__(cls)
        vars(codec).update(state)
        codec.memory, codec.pool, codec.sizes = {}, np.empty(0, np.int32), np.empty(0, np.int64)
        return codec

    def slices(self, texts: list[str]) -> list[list[bytes]]:
        """The UTF-8 slices of each text that are merged apart, as the published pattern cuts them."""
        joined = "\0".join(texts) + "\0"
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        stops = np.cumsum(sizes + 1) - 1
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        classes = self.classes[points]
        classes[stops] = BREAK
        marks = np.flatnonzero(boundaries(joined, points, classes))
        data = joined.encode("utf-8")
        cuts = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)[marks].tolist()
        parts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        out, first = [], 0
        for stop in np.searchsorted(marks, stops).tolist():
            out.append(parts[first:stop])
            first = stop + 1
        return out

    def learn(self, pieces: list[bytes]) -> None:
        """Remember the token ids of slices: themselves if tokens, else pairs merged by rank, leftmost first."""
        ranks = self.ranks
        names = [p for p in pieces if p in ranks]
        pools = [self.pool, np.array([ranks[p] for p in names], dtype=np.int32)]
        sizes = [self.sizes, np.ones(len(names), dtype=np.int64)]
        rows: dict[int, list[bytes]] = {}
        for piece in pieces:
            if piece not in ranks:
                rows.setdefault(min(-(-len(piece) // 4) * 4, LONG_PIECE + 1), []).append(piece)
        for width, group in rows.items():
            names += group
            if width > LONG_PIECE:
                made = [self._merged_long(p) for p in group]
                pools += [np.array(m, dtype=np.int32) for m in made]
                sizes.append(np.array([len(m) for m in made], dtype=np.int64))
            else:
                ids = self._merged_rows(group, width)
                kept = ids >= 0
                pools.append(ids[kept])
                sizes.append(kept.sum(axis=1))
        self.memory.update(zip(names, itertools.count(len(self.memory))))
        self.pool, self.sizes = np.concatenate(pools), np.concatenate(sizes)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of neighbouring tokens, NONE where it is no token."""
        asked = left.astype(np.int64) << 32 | right
        slots = _slot(asked, len(self.slot_keys))
        found = self.slot_keys[slots]
        out = np.where(found == asked, self.slot_ranks[slots], NONE)
        rest = np.flatnonzero((found != asked) & (found >= 0))
        if len(rest) and len(self.spilled):
            at = np.minimum(np.searchsorted(self.spilled, asked[rest]), len(self.spilled) - 1)
            out[rest] = np.where(self.spilled[at] == asked[rest], self.spilled_ranks[at], NONE)
        return out

    def _merged_rows(self, pieces: list[bytes], width: int) -> np.ndarray:
        """Many slices side by side: each round merges every row's pair of least rank.

        Tokens stay at the place of their first byte (-1 elsewhere) and know their neighbours' places.
        """
        sizes = np.array([len(p) for p in pieces])
        grid = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(-1, width)
        columns = np.arange(width)
        ids = np.where(columns < sizes[:, None], self.byte_ids[grid], -1).astype(np.int32)
        ranks = np.full(ids.shape, NONE, dtype=np.int32)
        inside = columns[1:] < sizes[:, None]
        ranks[:, :-1][inside] = self._pair_ranks(ids[:, :-1][inside], ids[:, 1:][inside])
        after = np.minimum(columns + 1, sizes[:, None])
        after[after == sizes[:, None]] = width
        ahead = np.broadcast_to(columns - 1, ids.shape).ravel().copy()
        flat, rank, after = ids.reshape(-1), ranks.reshape(-1), after.reshape(-1)
        live = np.arange(len(pieces))
        while len(live):
            open_ranks = ranks[live]
            at = open_ranks.argmin(axis=1)
            least = open_ranks[np.arange(len(live)), at]
            more = least != NONE
            live, at, least = live[more], at[more], least[more]
            base = live * width
            here = base + at
            gone = base + after[here]
            follow = after[gone]
            flat[here], flat[gone], after[here] = least, -1, follow
            rank[here] = rank[gone] = NONE
            has = np.flatnonzero(follow < width)
            place = base[has] + follow[has]
            ahead[place] = at[has]
            rank[here[has]] = self._pair_ranks(least[has], flat[place])
            has = np.flatnonzero(ahead[here] >= 0)
            place = base[has] + ahead[here[has]]
            rank[place] = self._pair_ranks(flat[place], least[has])
        return ids

    def _merged_long(self, piece: bytes) -> list[int]:
        """One slice with a heap of pairs and linked neighbours."""
        ranks, size = self.ranks, len(piece)
        after = list(range(1, size + 1))
        ahead = list(range(-1, size - 1))
        ends = list(range(1, size + 1))
        alive = [True] * size
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= size or ends[j] != end:
                continue
            alive[j] = False
            ends[i] = end
            after[i] = k = after[j]
            if k < size:
                ahead[k] = i
                if (r := ranks.get(piece[i : ends[k]])) is not None:
                    heapq.heappush(heap, (r, i, ends[k]))
            h = ahead[i]
            if h >= 0 and (r := ranks.get(piece[h:end])) is not None:
                heapq.heappush(heap, (r, h, end))
        return [ranks[piece[i : ends[i]]] for i in range(size) if alive[i]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = self.slices(texts)
        every = set(itertools.chain.from_iterable(parts))
        fresh = every - self.memory.keys()
        if len(self.memory) + len(fresh) > REMEMBERED:
            self.memory.clear()
            self.pool, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)
            fresh = every
        self.learn(sorted(fresh))
        begins = np.cumsum(self.sizes) - self.sizes
        known = self.memory.__getitem__
        out = []
        for part in parts:
            numbers = np.fromiter(map(known, part), dtype=np.int64, count=len(part))
            sizes = self.sizes[numbers]
            shift = begins[numbers] - (np.cumsum(sizes) - sizes)
            out.append(self.pool[np.repeat(shift, sizes) + np.arange(sizes.sum())])
        return out

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Byte offsets in the text at which the tokens end."""
        return np.cumsum(self.lengths[ids])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """The bytes of tokens, each put where its offset says."""
        if not len(ids):
            return b""
        size = self.lengths[ids]
        source = np.repeat(self.begins[ids] - (ends.astype(np.int64) - size), size) + np.arange(ends[-1])
        return self.bytes[source].tobytes()


def _shared(spark: SparkSession, ranks_path: str):
    """The codec, sent once to each executor; its size is that of the rank file and of Unicode."""
    with open(ranks_path, "rb") as file:
        return spark.sparkContext.broadcast(vars(Codec.of(file.read(), code_point_classes())))


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _numbers(rows: list[np.ndarray], kind) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind)))


def encode(docs: DataFrame, keep: list[str], text: str = "text", ranks_path: str | None = None) -> DataFrame:
    """`keep`, `ids` (token ids of the whole text) and `ends` (byte offset at which each token ends).

    The ids are those of the tiktoken library for the same ranks and the published pattern, without special
    tokens. Null and empty texts have no tokens. Repeated rows are encoded alike.
    """
    files = _shared(docs.sparkSession, ranks_path or default_ranks())

    def worker():
        codec = Codec.from_state(files.value)

        def run(texts: list[bytes]) -> list:
            ids = codec.encode([t.decode("utf-8", "replace") for t in texts])
            return [_numbers(ids, np.int32), _numbers([codec.ends(i) for i in ids], np.int32)]

        return run

    return map_texts(docs, keep, "ids array<int>, ends array<int>", worker, text)


def decode(encoded: DataFrame, keep: list[str], ids: str = "ids", ends: str = "ends", ranks_path: str | None = None) -> DataFrame:
    """`keep` and `decoded`, the bytes of the tokens, each put where its offset says. Null ids: no bytes."""
    files = _shared(encoded.sparkSession, ranks_path or default_ranks())
    frame = encoded.select(*keep, F.col(ids).alias("_ids"), F.col(ends).alias("_ends"))
    out = frame.select(*keep, F.lit(None).cast("binary").alias("decoded")).schema
    width = len(keep)

    def run(batches):
        codec = Codec.from_state(files.value)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                piece = batch.slice(start, SLICE)
                lists, stops = piece.column(width), piece.column(width + 1)
                made = []
                for row in range(piece.num_rows):
                    numbers, end = lists[row].values, stops[row].values
                    made.append(b"" if numbers is None else codec.decode(numbers.to_numpy(), end.to_numpy()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(i) for i in range(width)] + [pa.array(made, type=pa.binary())],
                    names=[*[piece.schema.field(i).name for i in range(width)], "decoded"],
                )

    return frame.mapInArrow(run, out)


def encode_checked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, ends, and `exact`: whether the decoded bytes are the text's (null: empty).

    Encodes and decodes in one pass, so the ids make no second way to the Python workers.
    """
    files = _shared(docs.sparkSession, ranks_path or default_ranks())

    def worker():
        codec = Codec.from_state(files.value)

        def run(texts: list[bytes]) -> list:
            ids = codec.encode([t.decode("utf-8", "replace") for t in texts])
            ends = [codec.ends(i) for i in ids]
            exact = [codec.decode(i, e) == t for i, e, t in zip(ids, ends, texts)]
            return [[len(i) for i in ids], _numbers(ids, np.int32), _numbers(ends, np.int32), exact]

        return run

    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_texts(frame, ["doc_id"], "n_tokens long, ids array<int>, ends array<int>, exact boolean", worker)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents"), ["doc_id"])
    return decode(encoded, ["doc_id", "ids"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
