"""Token counts of a unigram vocabulary: Aho-Corasick matches and a Viterbi pass that keeps counts only."""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.llm.common import map_texts, table

#: What an unknown character scores below the least piece, as the published tokenizers have it.
UNKNOWN_PENALTY = 10.0
BLANK = "▁"
#: Chunks whose result a task remembers.
REMEMBERED = 1 << 17


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores, and whether unknown characters count as their UTF-8 bytes or as one piece each run."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool


def load(path: str) -> Vocabulary:
    """The ordinary pieces of a SentencePiece model file with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    special = [i for i in numbers if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)]
    ordinary = sorted(set(numbers) - set(special))
    return Vocabulary(
        tuple((model.id_to_piece(i), model.get_score(i)) for i in ordinary), any(model.is_byte(i) for i in special)
    )


class Counter:
    """Best score and piece count of texts, without the pieces themselves."""

    def __init__(self, vocabulary: Vocabulary):
        self.byte_fallback = vocabulary.byte_fallback
        self.single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.memory: dict[str, tuple[float, int]] = {}
        # No piece reaches over the edge before a blank, or over a character that no piece has, so the best
        # path is that of the chunks between. Vocabularies that differ are taken as one chunk, and so are
        # texts whose unknown characters count by the run, since a run may reach over an edge.
        inside = any(BLANK in p.lstrip(BLANK) for p, _ in vocabulary.pieces) or not self.byte_fallback
        used = set().union(*(p for p, _ in vocabulary.pieces))
        breaks = "".join(c for c in "\n\t\r" if c not in used)
        part = f"[^{BLANK}{breaks}]"
        self.cut = None if inside else re.compile(f"{BLANK}+{part}*|{part}+" + (f"|[{breaks}]+" if breaks else ""))

    def count(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of a whole text; a blank is put before it. Empty: none."""
        if not text:
            return 0.0, 0
        text = BLANK + text.replace(" ", BLANK)
        if self.cut is None:
            return self.chunk(text)
        chunks = self.cut.findall(text)
        memory, score, pieces = self.memory, 0.0, 0
        for chunk in chunks:
            found = memory.get(chunk)
            if found is None:
                found = self.chunk(chunk)
                if len(memory) >= REMEMBERED:
                    memory.clear()
                memory[chunk] = found
            score += found[0]
            pieces += found[1]
        return score, pieces

    def chunk(self, text: str) -> tuple[float, int]:
        """The dynamic program: at each end the best score and its count, for starts in rising order.

        A later start replaces an earlier one only if it scores more, which is the tokenizers' rule for ties.
        A character that is no piece by itself may also stand for an unknown one, tried last.
        """
        size = len(text)
        best, pieces, unknown = [0.0] + [None] * size, [0] * (size + 1), [False] * (size + 1)
        known = self.single.issuperset(text)
        reached = 0
        for last, (length, score) in self.matches.iter(text):
            if not known and last > reached:
                self._unknown(text, best, pieces, unknown, reached, last)
                reached = last
            end, start = last + 1, last + 1 - length
            total = best[start] + score
            if best[end] is None or total > best[end]:
                best[end], pieces[end], unknown[end] = total, pieces[start] + 1, False
        if not known:
            self._unknown(text, best, pieces, unknown, reached, size)
        return best[size], pieces[size]

    def _unknown(self, text, best, pieces, unknown, first: int, stop: int) -> None:
        """Try unknown characters at the places from `first` to before `stop`, whose matches are all in."""
        for i in range(first, stop):
            if text[i] in self.single:
                continue
            total = best[i] + self.unknown
            if best[i + 1] is None or total > best[i + 1]:
                more = len(text[i].encode("utf-8", "replace")) if self.byte_fallback else int(not unknown[i])
                best[i + 1], pieces[i + 1], unknown[i + 1] = total, pieces[i] + more, True


def token_counts(docs: DataFrame, keep: list[str], vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """`keep`, n_tokens and score (sum of the piece scores) of each whole text.

    The best segmentation under the vocabulary's scores, ties as the published unigram tokenizers settle
    them. Null and empty texts have no tokens and score 0. Repeated rows count alike.
    """

    def worker():
        counter = Counter(vocabulary)

        def run(texts: list[bytes]) -> list:
            rows = [counter.count(t.decode("utf-8", "replace")) for t in texts]
            return [[n for _, n in rows], [s for s, _ in rows]]

        return run

    return map_texts(docs, keep, "n_tokens long, score double", worker, text)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    return token_counts(docs, ["doc_id", "n_chars"], vocabulary)
