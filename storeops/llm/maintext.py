"""The main text of web pages: the maximum-scoring run of words and tags, with weights from labelled pages.

A page is a sequence of tags and blocks of words. Words score positive, tags negative, each with a weight for
where it stands (inside an article element, outside of it, or on a page without one). Menus, adverts, forms,
scripts and the like are cut out first, as whole elements. One linear scan finds the run with the highest sum.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from storeops.llm.common import slices, table

#: About so many pages are looked at for labels: all of a smaller table, else those of the right hash.
LABEL_PAGES = 4000
#: Weights stay between these bounds; a tag or word place seen on no labelled page has the default.
TAG_BOUNDS, WORD_BOUNDS = (-4.0, -0.1), (0.5, 3.0)
TAG_DEFAULT, WORD_DEFAULT, OUTSIDE_DEFAULT = -1.0, 1.0, -1.0

# Element names and the words of classes, ids and roles that name what is no article text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUT = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript template head nav header footer aside menu form button select"
    " dialog object applet svg math canvas audio video map".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr img".split()
)
ROOTS = frozenset(["article", "main"])
NEVER_BY_CLASS = frozenset(["html", "body", "main"])
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promoted promotion sidebar"
    " widget widgets menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments reply replies respond"
    " disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing"
    " social related recommended recommendations teaser toolbar pagination pager login search copyright skip hidden".split()
)
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass
class Piece:
    """A tag (`name`, `end`: a closing one, `attributes` as written) or, without a name, a stretch of text."""

    name: str
    end: bool = False
    attributes: str = ""
    text: str = ""


def pieces(page: str) -> list[Piece]:
    """Tags and texts in order. Comments and declarations go; what scripts and the like hold is no markup.

    A quote that nothing closes counts as a plain character; whatever is open at the end reaches to the end.
    """
    out: list[Piece] = []
    at, size = 0, len(page)
    unquoted = {'"': size, "'": size}  # from here on nothing closes a quote
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            out.append(Piece("", text=page[at:start]))
        if start == size:
            break
        if page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            at = size if stop < 0 else stop + 3
            continue
        if page.startswith(("<!", "<?"), start):
            stop = page.find(">", start)
            at = size if stop < 0 else stop + 1
            continue
        end = page.startswith("</", start)
        found = _NAME.match(page, start + 1 + end)
        if not found:
            out.append(Piece("", text="<"))
            at = start + 1
            continue
        name, at = found[0].lower(), found.end()
        begin = at
        while True:
            stop = page.find(">", at)
            if stop < 0:
                stop = size
            quotes = [p for p in (page.find('"', at, stop), page.find("'", at, stop)) if p >= 0]
            if not quotes:
                break
            first = min(quotes)
            mark = page[first]
            close = -1 if first >= unquoted[mark] else page.find(mark, first + 1)
            if close < 0:
                unquoted[mark] = min(unquoted[mark], first)
                at = first + 1
            else:
                at = close + 1
        out.append(Piece(name, end, page[begin:stop]))
        at = min(size, stop + 1)
        if name in RAW and not end and not page[begin:stop].endswith("/"):
            closing = _CLOSING[name].search(page, at)
            at = closing.start() if closing else size
    return out


def partners(parts: list[Piece]) -> dict[int, int]:
    """For each opening tag that is closed, the number of the piece that closes it, one name at a time.

    A paragraph also ends where the next block begins or the block around it ends.
    """
    open_: dict[str, list[int]] = {}
    out: dict[int, int] = {}
    for i, p in enumerate(parts):
        if not p.name:
            continue
        if p.name not in INLINE and open_.get("p"):
            for start in open_.pop("p"):
                out[start] = i if p.end and p.name == "p" else i - 1
            if p.end and p.name == "p":
                continue
        if p.end:
            if open_.get(p.name):
                out[open_[p.name].pop()] = i
        elif p.name not in VOID:
            open_.setdefault(p.name, []).append(i)
    return out


def _named(p: Piece) -> bool:
    """Whether a class, id, role or state says that an element is no article text."""
    for found in _ATTRIBUTE.finditer(p.attributes):
        key = found[1].lower()
        value = found[2] or found[3] or found[4] or ""
        if key == "role" and value.strip().lower() in CUT_ROLES:
            return True
        if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if key in ("class", "id"):
            words = {w.lower() for w in _WORD.findall(value)}
            if words & CUT_WORDS or any(w.startswith("comment") for w in words):
                return True
    return False


def cut_out(parts: list[Piece], partner: dict[int, int]) -> list[bool]:
    """For each piece whether it belongs to an element that holds no article text.

    An element with an article, a main element or a first heading in it is a wrapper and stays, unless its own name
    tells what it is, or it holds no more than articles that go by their own class. One that nothing closes ends at the next article,
    main element or heading of the first rank, or where the element around it may end.
    """
    size = len(parts)
    anchors = [i for i, p in enumerate(parts) if p.name in ("article", "main", "h1") and not p.end and not (p.name == "article" and _named(p))]
    stops = [i for i, p in enumerate(parts) if p.name in ("article", "main", "body", "html", "h1") and (p.end or p.name in ("article", "main", "h1"))]
    out = [False] * size
    i = a = s = 0
    while i < size:
        p = parts[i]
        if not p.name or p.end:
            i += 1
            continue
        by_name = p.name in CUT
        if not by_name and (p.name in NEVER_BY_CLASS or not p.attributes or not _named(p)):
            i += 1
            continue
        if p.name in VOID:
            out[i] = True
            i += 1
            continue
        while a < len(anchors) and anchors[a] <= i:
            a += 1
        while s < len(stops) and stops[s] <= i:
            s += 1
        last = partner.get(i)
        if last is None:
            last = size - 1 if p.name in RAW else (stops[s] if s < len(stops) else size) - 1
        wraps = a < len(anchors) and anchors[a] <= last
        if wraps and (not by_name or p.name == "form") and p.name != "article":
            i += 1
            continue
        out[i : last + 1] = [True] * (last + 1 - i)
        i = last + 1
    return out


@dataclass
class Event:
    """A tag or a block of words with the place it stands in: in, out (of an article element) or plain."""

    name: str
    place: str
    text: str = ""
    words: int = 0


def events(page: str) -> list[Event]:
    """The live tags and blocks of a page in order. A block is the text between two tags that are not inline."""
    parts = pieces(page)
    partner = partners(parts)
    dead = cut_out(parts, partner)
    roots = [i for i, p in enumerate(parts) if p.name in ROOTS and not p.end and not dead[i]]
    inner = [i for i in roots if parts[i].name == "article"] or roots
    spans = [(i, partner.get(i, len(parts))) for i in inner]
    out: list[Event] = []
    texts: list[str] = []
    k, place = 0, "out" if spans else "plain"

    def close() -> None:
        words = "".join(texts).split()
        texts.clear()
        if words:
            out.append(Event("", place, " ".join(words), len(words)))

    for i, p in enumerate(parts):
        if spans:
            while k < len(spans) and i >= spans[k][1]:
                close()
                k += 1
            now = "in" if k < len(spans) and spans[k][0] < i < spans[k][1] else "out"
            if now != place:
                close()
                place = now
        if dead[i]:
            if p.name and p.name not in INLINE:
                close()
        elif not p.name:
            texts.append(html.unescape(p.text))
        else:
            if p.name not in INLINE:
                close()
            if not p.end:
                out.append(Event(p.name, place))
    close()
    return out


@dataclass
class Weights:
    """Scores of a word by place, and of tags by (name, place)."""

    words: dict[str, float]
    tags: dict[tuple[str, str], float]

    @classmethod
    def of(cls, counts: dict[tuple[str, str], tuple[int, int]]) -> Weights:
        """From how often each (name, place), words with an empty name, stands in and outside labelled text.

        The weight is the log odds of being inside, kept within the bounds. For pages without an article element
        the places are taken together.
        """

        def odds(keys) -> float | None:
            got = [counts[k] for k in keys if k in counts]
            inside, outside = (sum(g[j] for g in got) for j in (0, 1))
            return math.log((inside + 1) / (outside + 1)) if inside + outside else None

        def bounded(value: float | None, low: float, high: float, default: float) -> float:
            return default if value is None else min(high, max(low, value))

        names = {name for name, _ in counts if name}
        tags = {}
        for name in names:
            for place, keys in (("in", [(name, "in")]), ("out", [(name, "out")]), ("plain", [(name, "in"), (name, "out")])):
                tags[name, place] = bounded(odds(keys), *TAG_BOUNDS, TAG_DEFAULT)
        words = {
            "in": bounded(odds([("", "in")]), *WORD_BOUNDS, WORD_DEFAULT),
            "out": min(OUTSIDE_DEFAULT, odds([("", "out")]) or OUTSIDE_DEFAULT),
            "plain": bounded(odds([("", "in"), ("", "out")]), *WORD_BOUNDS, WORD_DEFAULT),
        }
        return cls(words, tags)

    def score(self, e: Event) -> float:
        if e.name:
            return self.tags.get((e.name, e.place), TAG_DEFAULT)
        return e.words * self.words[e.place]


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the run with the highest sum above 0, the first and then shortest of equal ones; (0, 0) if none."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, found = run, (start, i + 1)
    return found


def main_text(page: str, weights: Weights) -> str:
    every = events(page)
    start, end = best_run([weights.score(e) for e in every])
    return " ".join(e.text for e in every[start:end] if not e.name)


def page_counts(page: str) -> Counter | None:
    """How often each (name, place) stands inside and outside the page's one article; None if it has not just one."""
    every = events(page)
    entries = sum(1 for a, b in zip([Event("", "out"), *every], every) if b.place == "in" and a.place != "in")
    if entries != 1:
        return None
    counts: Counter = Counter()
    for e in every:
        counts[e.name, e.place, e.place == "in"] += e.words or 1
    return counts


def fit(pages: DataFrame, page: str = "html", label_pages: int = LABEL_PAGES) -> Weights:
    """Weights from the pages that label themselves: those with one article (or else main) element of text.

    About `label_pages` of them are read, chosen by a hash of the page; tasks give counts, which Spark adds up.
    Null and empty pages label nothing. Without any labelled page the weights are the defaults.
    """
    part = max(1, pages.count() // label_pages)
    sample = pages.select(F.col(page).alias("html")).where(F.pmod(F.xxhash64("html"), F.lit(part)) == 0)
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("place", T.StringType()), T.StructField("inside", T.LongType()), T.StructField("outside", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for piece in slices(batch, 0):
                for value in piece.column(0).to_pylist():
                    total.update(page_counts(value or "") or {})
        keys = sorted({k[:2] for k in total})
        columns = [[n for n, _ in keys], [p for _, p in keys], [total[n, p, True] for n, p in keys], [total[n, p, False] for n, p in keys]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    # Pages invent element names; those seen once tell nothing, and the most frequent few hundred are all that count.
    sums = sample.mapInArrow(run, schema).groupBy("name", "place").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    rows = sums.orderBy((F.col("inside") + F.col("outside")).desc(), "name", "place").limit(500).collect()
    return Weights.of({(r["name"], r["place"]): (r["inside"], r["outside"]) for r in rows})


def extract(pages: DataFrame, weights: Weights, keep: list[str], page: str = "html") -> DataFrame:
    """`keep` and the main `text` of each page.

    Character references are decoded; white space (Unicode's) inside a block becomes one space, blocks are trimmed
    and joined in page order by one space. Null, blank and wordless pages have an empty text; repeated rows give
    repeated rows; whole pages are read. Other columns are not read unless named in `keep`.
    """
    frame = pages.select(*keep, F.col(page).alias("_html"))
    schema = T.StructType(frame.drop("_html").schema.fields).add("text", T.StringType())
    arrow, width = to_arrow_schema(schema), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, width):
                texts = [main_text(value or "", weights) for value in piece.column(width).to_pylist()]
                yield pa.RecordBatch.from_arrays([*piece.columns[:width], pa.array(texts, pa.string())], schema=arrow)

    return frame.mapInArrow(run, schema)


def op13_maintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = extract(pages, fit(pages), ["page_id", "url"])
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
