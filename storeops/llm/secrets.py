"""Secrets in texts: known shapes, and sliding-window entropy per character class. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.llm.common import let, table

ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_MIN = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Candidate strings for the entropy windows.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

#: Characters of an entropy window, and bits that a window of each class must reach. A window belongs to the first
#: of these classes that has all its characters. A window of 20 can reach 4.32 bits.
WINDOW = 20
CLASSES = (("hex", 2.95), ("letters", 4.15), ("alphanumeric", 3.65), ("base64", 3.75))
#: Characters of a candidate that are passed over at a time.
BLOCK = 2048
#: Candidates that are known to be harmless as a whole: UUIDs, words joined by marks, times.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[+/_=-]*(?:[A-Z]?[a-z]+|[A-Z]+)(?:[+/_=-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[+/_=-]*$",
    r"^[0-9+/_=T-]+$",
)
#: Harmless strings inside candidates. They alone are passed over, not what they are glued to.
LISTED = (
    "0123456789", "123456789", "abcdefgh", "ABCDEFGH", "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]", "[Ss][Aa][Mm][Pp][Ll][Ee]",
    "[Cc][Hh][Aa][Nn][Gg][Ee][Mm][Ee]",
)
LISTED_SIZES = (10, 9, 8, 8, 7, 6, 8)
#: A character of a run of six or more x.
LISTED_X = "|".join(f"(?<=[Xx]{{{k}}})[Xx](?=[Xx]{{{5 - k}}})" for k in range(6))
#: Bits of a window of letters with at least CASED small and CASED capital ones; words joined by capitals have fewer.
CASED, CASED_BITS = 5, 3.5
KINDS = ("assign", "access", "hex", "entropy")

#: Window weights are whole numbers: c log2 c in units of 1e-9 bit, so sums do not depend on their order.
_UNIT = 10**9
_WEIGHTS = [0] + [round(c * math.log2(c) * _UNIT) for c in range(1, WINDOW + 2)]
_FIRST, _LAST = ord("+"), ord("z")

SPAN = "struct<start:int,end:int,kind:int,value:string>"
SPANS = f"array<{SPAN}>"


def matches(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """The leftmost non-overlapping matches with places in code points, if group `group` has `least` characters.

    Spark gives matches without places. The texts between them, cut at the same matches, add up to the places.
    """

    def step(at: Column, part: Column) -> Column:
        start = at["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        span = F.struct(
            start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), part["hit"].alias("value")
        ).cast(SPAN)
        kept = F.when(F.length(part["inner"]) >= least, F.concat(at["spans"], F.array(span))).otherwise(at["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    parts = F.zip_with(
        F.arrays_zip(gaps.alias("gap"), whole.alias("hit")),
        inner,
        lambda p, i: F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"), i.alias("inner")),
    )
    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    found = F.aggregate(parts, first, step, lambda at: at["spans"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPANS))


def _most(bits: float) -> int:
    """The weight sum that a window of so many bits has."""
    return int((math.log2(WINDOW) - bits) * (WINDOW * _UNIT))


def _most_of_window(counts: Column) -> Column:
    """The weight sum that a window may have by the class of its own characters; -1 where none counts."""
    bits = dict(CLASSES)

    def total(first: str, last: str) -> Column:
        part = F.slice(counts, ord(first) - _FIRST + 1, ord(last) - ord(first) + 1)
        return F.aggregate(part, F.lit(0), lambda a, c: a + c)

    kinds = F.struct(
        total("0", "9").alias("digits"),
        total("a", "z").alias("small"),
        total("A", "Z").alias("large"),
        total("a", "f").alias("small_hex"),
        total("A", "F").alias("large_hex"),
    )

    def limit(k: Column) -> Column:
        hexes = (k["digits"] + k["small_hex"] == WINDOW) | (k["digits"] + k["large_hex"] == WINDOW)
        out = F.when(k["digits"] == WINDOW, F.lit(-1)).when(hexes, F.lit(_most(bits["hex"])))
        letters = k["small"] + k["large"]
        cased = (letters == WINDOW) & (k["small"] >= CASED) & (k["large"] >= CASED)
        out = out.when(cased, F.lit(_most(CASED_BITS))).when(letters == WINDOW, F.lit(_most(bits["letters"])))
        out = out.when(k["digits"] + letters == WINDOW, F.lit(_most(bits["alphanumeric"])))
        return out.otherwise(F.lit(_most(bits["base64"]))).cast("long")

    return let(kinds, limit)


def hot_windows(value: Column) -> Column:
    """Merged [start, end) places of the windows of a string whose entropy reaches the threshold of their class.

    A long string is passed over in blocks, each with the first characters of the next, so that every window lies
    in one; the work is linear in its length. Places that touch are one.
    """
    blocks = F.regexp_extract_all(value, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def of_blocks(b: Column) -> Column:
        def shifted(block: Column, i: Column) -> Column:
            rest = F.coalesce(F.substring(F.get(b, i + 1), 1, WINDOW - 1), F.lit(""))
            return F.transform(
                _windows_of(F.concat(block, rest)),
                lambda w: F.struct((w["start"] + i * BLOCK).alias("start"), (w["end"] + i * BLOCK).alias("end")),
            )

        return F.flatten(F.transform(b, shifted))

    def joined(w: Column) -> Column:
        begins = F.filter(w, lambda x, i: (i == 0) | (x["start"] > F.get(w, i - 1)["end"]))
        ends = F.filter(w, lambda x, i: (i == F.size(w) - 1) | (F.get(w, i + 1)["start"] > x["end"]))
        return F.zip_with(begins, ends, lambda x, y: F.struct(x["start"].alias("start"), y["end"].alias("end")))

    return let(let(blocks, of_blocks), joined)


def _windows_of(value: Column) -> Column:
    """The merged hot windows of one block.

    One pass: the entering and the leaving character change their counts and the weight sum by one step each.
    The entropy of a window is log2(WINDOW) less the sum of c log2 c over its counts, divided by WINDOW.
    """
    weights = F.array(*[F.lit(w).cast("long") for w in _WEIGHTS])
    least_bits = min(*(bits for _, bits in CLASSES), CASED_BITS)
    counts = F.array_repeat(F.lit(0), _LAST - _FIRST + 1)
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - (_FIRST - 1))
    spans = F.array().cast("array<struct<start:int,end:int>>")
    state = F.struct(
        F.lit(0).alias("n"), counts.alias("counts"), F.lit(0).cast("long").alias("weight"), spans.alias("spans")
    )

    def weight(count: Column) -> Column:
        return F.element_at(weights, count + 1)

    def step(all_codes: Column) -> Callable[[Column, Column], Column]:
        def advance(s: Column, code: Column) -> Column:
            leaving = F.when(s["n"] >= WINDOW, F.element_at(all_codes, F.greatest(s["n"] - (WINDOW - 1), F.lit(1))))
            leaving = F.coalesce(leaving, F.lit(0))
            return let(
                F.struct(F.element_at(s["counts"], code).alias("up"), leaving.alias("gone")),
                lambda x: let(
                    F.struct(
                        x["up"].alias("up"),
                        x["gone"].alias("gone"),
                        F.when(x["gone"] > 0, F.element_at(s["counts"], F.greatest(x["gone"], F.lit(1))) + (x["gone"] == code).cast("int"))
                        .otherwise(F.lit(1))
                        .alias("down"),
                    ),
                    lambda y: _moved(s, code, y),
                ),
            )

        return advance

    def _moved(s: Column, code: Column, y: Column) -> Column:
        total = s["weight"] + weight(y["up"] + 1) - weight(y["up"]) + F.when(
            y["gone"] > 0, weight(y["down"] - 1) - weight(y["down"])
        ).otherwise(F.lit(0).cast("long"))
        moved = F.transform(
            s["counts"], lambda c, j: c + (j + 1 == code).cast("int") - (j + 1 == y["gone"]).cast("int")
        )
        n = s["n"] + 1

        def after(v: Column) -> Column:
            hot = F.when((n >= WINDOW) & (v["weight"] <= _most(least_bits)), v["weight"] <= _most_of_window(v["counts"]))
            spans = F.when(hot.otherwise(F.lit(False)), _grown(s["spans"], n)).otherwise(s["spans"])
            return F.struct(n.alias("n"), v["counts"].alias("counts"), v["weight"].alias("weight"), spans.alias("spans"))

        return let(F.struct(total.alias("weight"), moved.alias("counts")), after)

    def _grown(spans: Column, end: Column) -> Column:
        size = F.size(spans)
        last = F.try_element_at(spans, F.lit(-1))
        new = F.struct((end - WINDOW).alias("start"), end.alias("end"))
        wider = F.struct(last["start"].alias("start"), end.alias("end"))
        return F.when(
            F.coalesce(last["end"] >= end - WINDOW, F.lit(False)),
            F.concat(F.slice(spans, F.lit(1), F.greatest(size - 1, F.lit(0))), F.array(wider)),
        ).otherwise(F.concat(spans, F.array(new)))

    return let(codes, lambda c: F.aggregate(c, state, step(c), lambda s: s["spans"]))


def entropy_spans(text: Column) -> Column:
    """Spans of kind entropy, without values: the hot windows of the candidate strings around the LISTED ones.

    Candidates, and what the listed strings leave of them, are passed over if an entry of ALLOWED covers them whole.
    """

    def harmless(value: Column) -> Column:
        test = value.rlike(ALLOWED[0])
        for pattern in ALLOWED[1:]:
            test = test | value.rlike(pattern)
        return test

    def blanked(value: Column) -> Column:
        out = value
        for pattern, size in zip(LISTED, LISTED_SIZES):
            out = F.regexp_replace(out, pattern, " " * size)
        return F.regexp_replace(out, LISTED_X, " ")

    def inner(candidate: Column) -> Column:
        pieces = F.filter(matches(blanked(candidate["value"]), CANDIDATE, -1), lambda p: ~harmless(p["value"]))
        return F.flatten(F.transform(pieces, lambda p: spans_of(candidate["start"] + p["start"], p["value"])))

    def spans_of(start: Column, value: Column) -> Column:
        return F.transform(
            hot_windows(value),
            lambda w: F.struct(
                (start + w["start"]).alias("start"),
                (start + w["end"]).alias("end"),
                F.lit(KINDS.index("entropy")).alias("kind"),
                F.lit(None).cast("string").alias("value"),
            ).cast(SPAN),
        )

    candidates = F.filter(matches(text, CANDIDATE, -1), lambda c: ~harmless(c["value"]))
    return F.flatten(F.transform(candidates, inner))


def find_secrets(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep`, `base` and `spans`: arrays of (start, end, kind, value), sorted by start and kind.

    `base` has the known shapes, `spans` those and the entropy spans that reach beyond every base span; those have
    no value of their own. The work on a run of characters is linear in its length.
    Places are code points of the whole text, end exclusive. Null texts count as empty and hold nothing;
    other columns are passed on only if named in `keep`.
    """
    frame = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    t = F.col("_text")
    base = F.array_sort(F.concat(matches(t, ASSIGN, 0, 2, ASSIGN_MIN), matches(t, ACCESS, 1), matches(t, HEX, 2)))
    frame = frame.select("*", base.alias("base"), entropy_spans(t).alias("_more"))
    more = F.filter(
        "_more", lambda m: ~F.exists("base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"]))
    )
    return frame.select(*keep, "base", F.array_sort(F.concat("base", more)).alias("spans"))


def digest(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(docs: DataFrame, text: str = "text", size: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """`docs`, all columns, with each run of overlapping spans in the text replaced by a mark and its size set anew.

    Texts without secrets, null ones included, stay as they are. The second column is left out if absent.
    """
    found = find_secrets(docs.withColumn("_whole", F.struct(*docs.columns)), ["_whole"], text)
    whole = F.col("_whole")
    body = whole[text]

    def cover(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        piece = F.concat(state["out"], F.substring(body, state["at"] + 1, span["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"), F.when(fresh, piece).otherwise(state["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        "spans", start, cover, lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.lit(2**31 - 1) - s["at"] - 1))
    )
    clean = F.when(F.size("spans") > 0, done).otherwise(body)
    columns = [whole[c].alias(c) for c in docs.columns if c not in (text, size)]
    frame = found.select(*columns, clean.alias(text), (whole[size] if size in docs.columns else F.lit(None)).alias("_size"), F.size("spans").alias("_n"))
    if size in docs.columns:
        frame = frame.withColumn(size, F.when(F.col("_n") > 0, F.length(text).cast("long")).otherwise(F.col("_size")))
    return frame.select(*docs.columns)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS[:3]), F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans")
    )


def twin() -> str:
    """The same rows in DuckDB SQL: every window counted anew, touching ones joined as islands."""

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def hits(kind: int, pattern: str, group: int = 0, least: int = 0) -> str:
        p = quoted(pattern)
        return f"""SELECT doc_id, {kind} AS kind, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS stop, inside
FROM (SELECT doc_id, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS hit, unnest(inner_parts) AS inside, unnest(gaps[1:len(found)]) AS gap
      FROM (SELECT doc_id, regexp_extract_all(t, {p}) AS found, regexp_extract_all(t, {p}, {group}) AS inner_parts,
                   string_split_regex(t, {p}) AS gaps FROM d WHERE regexp_matches(t, {p})) parts) m
QUALIFY length(inside) >= {least}"""

    def hits_of(source: str, value: str, columns: str, pattern: str) -> str:
        """Matches of a pattern in a column of a table, with their place from 0."""
        p = quoted(pattern)
        return f"""SELECT {columns}, hit, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY {columns} ORDER BY i) - length(hit) AS BIGINT) AS place
FROM (SELECT {columns}, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS hit, unnest(gaps[1:len(found)]) AS gap
      FROM (SELECT {columns}, regexp_extract_all({value}, {p}) AS found, string_split_regex({value}, {p}) AS gaps FROM {source} WHERE regexp_matches({value}, {p})) parts) m"""

    blank = "hit"
    for pattern, size in zip(LISTED, LISTED_SIZES):
        blank = f"regexp_replace({blank}, {quoted(pattern)}, '{' ' * size}', 'g')"
    runs = "regexp_extract_all(b, '[Xx]{6,}')"
    blanked = f"array_to_string(list_transform(list_zip(string_split_regex(b, '[Xx]{{6,}}'), {runs}), lambda z: z[1] || repeat(' ', coalesce(length(z[2]), 0))), '')"
    harmless = " OR ".join(f"regexp_matches(hit, {quoted(p)})" for p in ALLOWED)
    bits = dict(CLASSES)
    several = f"length(regexp_replace(part, '[^a-z]', '', 'g')) >= {CASED} AND length(regexp_replace(part, '[^A-Z]', '', 'g')) >= {CASED}"
    most = f"""CASE WHEN regexp_full_match(part, '[0-9]+') THEN -1
        WHEN regexp_full_match(part, '[0-9a-f]+|[0-9A-F]+') THEN {_most(bits["hex"])}
        WHEN regexp_full_match(part, '[A-Za-z]+') AND {several} THEN {_most(CASED_BITS)}
        WHEN regexp_full_match(part, '[A-Za-z]+') THEN {_most(bits["letters"])}
        WHEN regexp_full_match(part, '[A-Za-z0-9]+') THEN {_most(bits["alphanumeric"])} ELSE {_most(bits["base64"])} END"""
    names = ", ".join(quoted(k) for k in KINDS)

    def told(table: str) -> str:
        return f"string_agg(([{names}])[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind)"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT doc_id, kind, CAST(stop - length(hit) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM (
{hits(0, ASSIGN, 2, ASSIGN_MIN)} UNION ALL {hits(1, ACCESS)} UNION ALL {hits(2, HEX)}) b),
candidates AS (SELECT doc_id, place AS origin, {blank} AS b FROM ({hits_of('d', 't', 'doc_id', CANDIDATE)}) c WHERE NOT ({harmless})),
plain AS (SELECT doc_id, origin, {blanked} AS b FROM candidates),
pieces AS (SELECT doc_id, origin + place AS origin, hit FROM ({hits_of('plain', 'b', 'doc_id, origin', CANDIDATE)}) c WHERE NOT ({harmless})),
windows AS (SELECT doc_id, origin, i, substr(hit, i + 1, {WINDOW}) AS part
            FROM (SELECT *, unnest(range(0, length(hit) - {WINDOW - 1})) AS i FROM pieces) w),
hot AS (SELECT doc_id, origin, i FROM windows WHERE list_sum([({_WEIGHTS[: WINDOW + 1]})[1 + length(part) - length(replace(part, c, ''))]
        FOR c IN list_distinct(string_split(part, ''))]) <= {most}),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, origin ORDER BY i) AS island FROM (
            SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id, origin ORDER BY i) + {WINDOW} THEN 0 ELSE 1 END AS fresh FROM hot) h),
more AS (SELECT doc_id, {KINDS.index('entropy')} AS kind, CAST(origin + min(i) AS BIGINT) AS start, CAST(origin + max(i) + {WINDOW} AS BIGINT) AS stop
         FROM islands GROUP BY doc_id, origin, island),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM more m WHERE NOT EXISTS (
          SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.start <= m.start AND m.stop <= b.stop)),
b AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             {told('base')} AS told FROM base GROUP BY doc_id),
s AS (SELECT doc_id, {told('spans')} AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(told, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN s USING (doc_id)
"""


#: Holds for tables in which each doc_id has one row, as the given ones.
OP5_SQL = twin()
