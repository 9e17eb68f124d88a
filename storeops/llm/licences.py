"""Licence scans: phrases and identifier tags by Aho-Corasick, licence expressions by a shunting yard."""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.llm.common import ASCII_LOWER, map_texts, table

#: Phrases and labels of the base scan.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: How much a licence asks, from 0 (nothing) to 1 (no free use).
FREE, NOTICE, WEAK, STRONG, CLOSED = 0.0, 0.25, 0.5, 0.75, 1.0

#: Notice phrases as word sequences; the label and what it asks.
NOTICES = {
    "apache license version 2 0": ("apache-2.0", NOTICE),
    "permission is hereby granted free of charge": ("mit-notice", NOTICE),
    "redistribution and use in source and binary forms": ("bsd-notice", NOTICE),
    "bsd 2 clause": ("bsd-2-clause", NOTICE),
    "bsd 3 clause": ("bsd-3-clause", NOTICE),
    "isc license": ("isc", NOTICE),
    "mozilla public license": ("mpl", WEAK),
    "eclipse public license": ("epl", WEAK),
    "lesser general public license": ("lgpl", WEAK),
    "gnu general public license": ("gnu-gpl", STRONG),
    "general public license version 2": ("gpl-2.0", STRONG),
    "general public license version 3": ("gpl-3.0", STRONG),
    "affero general public license": ("agpl", STRONG),
    "cc0": ("cc0", FREE),
    "cc by 4 0": ("cc-by-4.0", NOTICE),
    "cc by sa 4 0": ("cc-by-sa-4.0", WEAK),
    "cc by nc 4 0": ("cc-by-nc-4.0", CLOSED),
    "cc by nd 4 0": ("cc-by-nd-4.0", CLOSED),
    "creative commons attribution": ("creative-commons", NOTICE),
    "public domain": ("public-domain", FREE),
    "unlicense": ("unlicense", FREE),
    "all rights reserved": ("all-rights-reserved", CLOSED),
}
BASE_ASKS = {"mit": NOTICE, "apache": NOTICE, "gpl": STRONG}

#: Identifier beginnings in licence expressions and what they ask; others count as closed.
IDENTIFIERS = (
    ("0bsd", FREE), ("cc0", FREE), ("unlicense", FREE), ("mit", NOTICE), ("apache", NOTICE), ("bsd", NOTICE), ("isc", NOTICE),
    ("zlib", NOTICE), ("cc-by-nc", CLOSED), ("cc-by-nd", CLOSED), ("cc-by-sa", WEAK), ("cc-by", NOTICE), ("mpl", WEAK),
    ("lgpl", WEAK), ("epl", WEAK), ("cddl", WEAK), ("agpl", STRONG), ("gpl", STRONG),
)
TAG = "spdx-license-identifier:"
#: An expression ends with its line at the latest.
EXPRESSION = re.compile(rb"[^\r\n]*")
BLANKS = re.compile(r"[\x20\t]*")
TOKEN = re.compile(r"[a-z0-9][a-z0-9.+:-]*|[()]")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

#: Word bytes lower-cased, all others blank: 0-9, a-z and everything beyond ASCII make words.
_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in ASCII_LOWER)

SCHEMA = (
    "n_words long, base array<struct<label:string,word:long>>, notices array<struct<label:string,word:long>>, "
    "expressions array<struct<expression:string,asks:double>>, score double"
)


def asks(identifier: str) -> float:
    """What a licence asks, by the beginning of its identifier."""
    return next((value for name, value in IDENTIFIERS if identifier.startswith(name)), CLOSED)


def evaluate(expression: str) -> tuple[float, list[str]] | None:
    """What an expression asks, and its identifiers; None if it is malformed.

    `or` leaves the choice, so the lesser counts; `and` binds to both, so the greater; an exception after
    `with` softens a strong licence to a weak one. `with` binds tightest, then `and`, then `or`. Two stacks
    (Dijkstra's shunting yard), no recursion.
    """
    values: list[float] = []
    operators: list[str] = []
    names: list[str] = []

    def apply() -> None:
        operator, right, left = operators.pop(), values.pop(), values.pop()
        values.append({"or": min, "and": max, "with": lambda x, _: min(x, WEAK) if x < CLOSED else x}[operator](left, right))

    operand = True
    for token in TOKEN.findall(expression):
        if operand and token == "(":
            operators.append(token)
        elif operand and token not in PRECEDENCE and token != ")":
            if not (operators and operators[-1] == "with"):
                names.append(token)
            values.append(asks(token))
            operand = False
        elif not operand and token in PRECEDENCE:
            while operators and operators[-1] != "(" and PRECEDENCE[operators[-1]] >= PRECEDENCE[token]:
                apply()
            operators.append(token)
            operand = True
        elif not operand and token == ")":
            while operators and operators[-1] != "(":
                apply()
            if not operators:
                return None
            operators.pop()
        else:
            return None
    if operand:
        return None
    while operators:
        if operators[-1] == "(":
            return None
        apply()
    return values[0], sorted(set(names))


def longest(line: str) -> tuple[str, float, list[str]] | None:
    """The longest well-formed expression at the start of a line, what it asks, and its identifiers; None without.

    Only blanks stand between its tokens; the first token that cannot continue it ends it. Full stops, colons
    and hyphens behind an identifier are the sentence's. An expression that its line's end cuts is malformed.
    """
    tokens: list[str] = []
    complete = depth = at = 0
    operand = True
    while match := TOKEN.match(line, BLANKS.match(line, at).end()):
        raw = match.group()
        token = raw.rstrip(".:-")
        if operand and token == "(":
            depth += 1
        elif operand and token not in PRECEDENCE and token != ")":
            operand = False
        elif not operand and token in PRECEDENCE:
            operand = True
        elif not operand and token == ")" and depth:
            depth -= 1
        else:
            break
        tokens.append(token)
        at = match.end()
        if not operand and not depth:
            complete = len(tokens)
        if token != raw:
            break
    cut = (operand or depth) and BLANKS.match(line, at).end() == len(line)
    if cut or not complete:
        return None
    said = " ".join(tokens[:complete])
    return said, *evaluate(said)


def tag_automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    made.add_word(TAG, len(TAG))
    made.make_automaton()
    return made


def automaton() -> ahocorasick.Automaton:
    """All phrases, each between blanks; one phrase may serve the base scan and the notices."""
    made = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES}:
        made.add_word(f" {phrase} ", (len(phrase) + 2, BASE.get(phrase), NOTICES.get(phrase)))
    made.make_automaton()
    return made


def scan(text: bytes, phrases: ahocorasick.Automaton, tags: ahocorasick.Automaton) -> tuple:
    """One row of SCHEMA for a whole text."""
    words = text.translate(_WORDS).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    base, notices, worst = [], [], FREE
    seen = at = 0
    for end, (length, label, notice) in sorted(phrases.iter(line), key=lambda hit: hit[0] - hit[1][0]):
        begin = end + 1 - length
        at += line.count(" ", seen, begin)
        seen = begin
        if label:
            base.append((label, at))
            worst = max(worst, BASE_ASKS[label])
        if notice:
            notices.append((notice[0], at))
            worst = max(worst, notice[1])
    expressions = []
    lower = text.translate(ASCII_LOWER)
    for last, _ in tags.iter(lower.decode("latin-1")):
        found = longest(EXPRESSION.match(lower, last + 1).group().decode("utf-8", "replace"))
        if found is not None:
            expressions.append(found[:2])
            notices += [(name, None) for name in found[2]]
            worst = max(worst, found[1])
    return len(words), base, notices, expressions, worst


def find_licences(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` and SCHEMA: number of words, base hits and notices with their word, expressions, score.

    `score` is what the most demanding find asks, 0 without any. Identifiers of expressions count as notices
    without a word; of what follows a tag the longest well-formed expression counts, if there is one. Null texts count as empty. Repeated phrases all
    count. Other columns are passed on only if named in `keep`.
    """

    def worker():
        phrases, tags = automaton(), tag_automaton()

        def run(texts: list[bytes]) -> list:
            rows = [scan(t, phrases, tags) for t in texts]
            n, base, notices, expressions, score = zip(*rows) if rows else [()] * 5
            pairs = [[[{"label": a, "word": b} for a, b in hits] for hits in column] for column in (base, notices)]
            said = [[{"expression": a, "asks": b} for a, b in hits] for hits in expressions]
            return [list(n), *pairs, said, list(score)]

        return run

    return map_texts(docs, keep, SCHEMA, worker, text)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    words = F.col("base.word")
    return find_licences(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat(F.col("base.label"), F.col("notices.label"))).alias("labels"),
        "score",
    )
