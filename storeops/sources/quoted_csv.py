"""CSV records with line breaks inside quotes, read by many tasks per file.

A task sees the lines of a byte range and cannot know whether the first of them lies inside quotes. So each range
is scanned under both assumptions, which gives a function from its first state to its last; composing the
functions in file order settles every range's first state. With the states known, each task joins its lines to
records, and only a record that crosses from one range into another is put together from parts.

Only lines with a quote are scanned in Python, since others change no state. Stretches of lines without one are cut
at their commas as whole Arrow arrays; only the other lines are taken one by one.
"""

from __future__ import annotations

import csv
import io
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# What a row of `_pieces` is: a record, the rest of one that an earlier range began, or the begin of one.
WHOLE, REST, BEGIN = 0, 1, 2

# Shorter stretches of plain lines are not worth the calls that an Arrow array takes.
STRETCH = 64

RANGE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("from_outside", T.BooleanType()),
        T.StructField("from_inside", T.BooleanType()),
    ]
)
PIECE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("record", T.StringType()),
        T.StructField("fields", T.ArrayType(T.StringType())),
    ]
)


def inside_after(line: bytes, inside: bool) -> bool:
    """Whether a line that begins inside (or outside of) quotes ends inside them.

    A quote opens a field only at its start; a doubled one inside a quoted field is a plain character.
    """
    at = 0
    while True:
        if not inside and line[at : at + 1] == b'"':
            inside, at = True, at + 1
        if inside:
            at = line.find(b'"', at)
            while at >= 0 and line[at + 1 : at + 2] == b'"':
                at = line.find(b'"', at + 2)
            if at < 0:
                return True
            inside, at = False, at + 1
        at = line.find(b",", at) + 1
        if not at:
            return False


def text_lines(spark: SparkSession, paths: list[str] | str, pattern: str | None = None) -> DataFrame:
    """(file, name, block, value): the lines of each byte range of each file, in order within a range."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    meta = F.col("_metadata")
    return reader.text(paths).select(
        meta["file_path"].alias("file"), meta["file_name"].alias("name"), meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("value")
    )


def has_quote() -> Column:
    return F.col("value").cast("string").contains('"')


def ranges(lines: DataFrame) -> DataFrame:
    """RANGE rows: for each byte range with a quote the state at its end under either state at its start."""
    arrow = to_arrow_schema(RANGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, into = None, False, True

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, out, into), arrow)], schema=arrow)

        for batch in batches:
            for file, block, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (file, block) != now:
                    if now is not None:
                        yield told()
                    now, out, into = (file, block), False, True
                out, into = inside_after(value, out), inside_after(value, into)
        if now is not None:
            yield told()

    return lines.where(has_quote()).select("file", "block", "value").mapInArrow(run, RANGE)


def quoted_starts(lines: DataFrame) -> dict[str, list[int]]:
    """For each file the ranges, in order, that begin inside quotes; files without any are left out.

    From outside, a file gets inside only by a range that ends so. Where there is one, the ranges without a quote,
    which keep the state, are listed too.
    """
    if ranges(lines).where("from_outside").isEmpty():
        return {}
    plain = lines.groupBy("file", "block").agg(F.bool_or(has_quote()).alias("quotes")).where("not quotes")
    keep = plain.select("file", "block", F.lit(False).alias("from_outside"), F.lit(True).alias("from_inside"))
    return {r["file"]: list(r["blocks"]) for r in starts_inside(ranges(lines).unionByName(keep)).collect()}


def starts_inside(found: DataFrame) -> DataFrame:
    """(file, blocks): the ranges, in order, that begin inside quotes; files without any have no row."""
    range_ = F.struct("block", "from_outside", "from_inside")
    files = found.groupBy("file").agg(F.sort_array(F.collect_list(range_)).alias("ranges"))

    def step(state: Column, r: Column) -> Column:
        blocks = F.when(state["inside"], F.concat(state["blocks"], F.array(r["block"]))).otherwise(state["blocks"])
        return F.struct(F.when(state["inside"], r["from_inside"]).otherwise(r["from_outside"]).alias("inside"), blocks.alias("blocks"))

    first = F.struct(F.lit(False).alias("inside"), F.array().cast("array<bigint>").alias("blocks"))
    return files.select("file", F.aggregate("ranges", first, step, lambda s: s["blocks"]).alias("blocks")).where(F.size("blocks") > 0)


def cut(record: str, width: int) -> list[str | None]:
    """The texts of a record's first `width` fields; an empty or missing one is null."""
    values = next(csv.reader(io.StringIO(record, newline="")), [])[:width]
    return [v or None for v in values] + [None] * (width - len(values))


def cut_plain(lines: pa.Array, width: int) -> pa.Array:
    """The same for lines without quotes and line breaks, empty ones left out; missing fields are not filled up."""
    lists = pc.split_pattern(lines.filter(pc.not_equal(lines, "")), ",", max_splits=width)
    values = pc.if_else(pc.equal(lists.values, ""), None, lists.values)
    return pc.list_slice(pa.ListArray.from_arrays(lists.offsets, values), 0, width)


def plain_lines(values: pa.Array) -> tuple[pa.Array | None, list[int]]:
    """The lines as texts without their line ends, and the numbers of those with quotes or further line ends.

    There are no texts if a line is no UTF-8.
    """
    try:
        lines = values.cast(pa.string())
    except pa.ArrowInvalid:
        return None, []
    hard = pc.match_substring(lines, '"')
    if pc.any(pc.match_substring(lines, "\r")).as_py():
        lines = pc.if_else(pc.ends_with(lines, "\r"), pc.utf8_slice_codeunits(lines, 0, -1), lines)
        hard = pc.or_(hard, pc.match_substring(lines, "\r"))
    return lines, pc.indices_nonzero(hard).to_pylist()


def spans(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """From and to of the rows of one range, for the ranges of a batch of lines."""
    if batch.num_rows:
        file, block = batch.column(0), batch.column(2)
        changes = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
        starts = [0, *(i + 1 for i in pc.indices_nonzero(changes).to_pylist())]
        yield from zip(starts, [*starts[1:], batch.num_rows])


def _pieces(lines: DataFrame, inside: dict[str, list[int]], width: int, only_inside: bool = False) -> DataFrame:
    """PIECE rows: fields of records, and the parts of those that cross ranges. The first record of a file is its header.

    `only_inside` leaves out files that `inside` does not name. A filter on the frame would do so as well, but a scan
    of fewer files is split into other ranges.
    """
    arrow = to_arrow_schema(PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        now: tuple | None = None
        held: list[bytes] = []
        open_ = rest = header = False
        rows: list[tuple] = []

        def close(last: bool) -> None:
            nonlocal held, rest, header
            text = b"\n".join(held)
            if last and open_:  # goes on in the next range, if there is one
                blocks = inside.get(now[0], [])
                kind = REST if rest else BEGIN if bisect_right(blocks, now[2]) < len(blocks) else WHOLE
            else:
                kind = REST if rest else WHOLE
            if kind != REST and not text.strip(b"\r"):
                pass
            elif header and kind != REST:
                header = False
                if kind == BEGIN:
                    rows.append((*now, kind, None, None))
            else:
                goes_on = last and open_ and kind != WHOLE
                body = text[:-1] if text.endswith(b"\r") and not goes_on else text
                record = body.decode("utf-8", "replace")
                rows.append((*now, kind, None, cut(record, width)) if kind == WHOLE else (*now, kind, record, None))
            held, rest = [], False

        def take(value: bytes) -> None:
            nonlocal open_
            held.append(value)
            if b'"' in value:
                open_ = inside_after(value, open_)
            if not open_:
                close(False)

        def out() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(arrow)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
            rows.clear()
            return batch

        def out_plain(cuts: pa.Array) -> pa.RecordBatch:
            n = len(cuts)
            known = {"name": pa.repeat(now[1], n), "kind": pa.repeat(pa.scalar(WHOLE, pa.int32()), n), "fields": cuts}
            columns = [known[f.name].cast(f.type) if f.name in known else pa.nulls(n, f.type) for f in arrow]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for start, end in spans(batch):
                file, name, block = (batch.column(i)[start].as_py() for i in range(3))
                if only_inside and file not in inside:
                    continue
                values, at = batch.column(3).slice(start, end - start), 0
                if now is None or (file, block) != (now[0], now[2]):
                    if held:
                        close(True)
                    now, header = (file, name, block), block == 0
                    open_ = rest = block in inside.get(file, ())
                    if header:
                        take(values[0].as_py().removeprefix(b"\xef\xbb\xbf"))
                        at = 1
                texts, hard = plain_lines(values)
                taken = values.to_pylist() if texts is None or hard or open_ or header else []
                for stop in [*hard, len(values)]:
                    while at < stop and (open_ or header or texts is None or stop - at < STRETCH):
                        take(taken[at] if taken else values[at].as_py())
                        at += 1
                    if at < stop:
                        yield out_plain(cut_plain(texts.slice(at, stop - at), width))
                        at = stop
                    if at == stop < len(values):
                        take(taken[at])
                        at += 1
            yield out()
        if held:
            close(True)
        yield out()

    return lines.mapInArrow(run, PIECE)


def read(spark: SparkSession, paths: list[str] | str, pattern: str | None, width: int) -> DataFrame:
    """(name, fields): the file's name and the first `width` fields of each CSV record but the header.

    Line breaks in quotes are part of the field; an empty field is null, missing ones are null or left out. Files are
    split by Spark as any text is. Line ends are LF or CRLF; empty lines are no records; a quote that nothing closes
    reaches to the end of the file. Other than one row per range that starts inside quotes, nothing comes to the driver.
    """
    lines = text_lines(spark, paths, pattern)
    inside = quoted_starts(lines)
    whole = _pieces(lines, inside, width).where(F.col("kind") == WHOLE).select("name", "fields")
    if not inside:
        return whole
    parts = _pieces(lines, inside, width, only_inside=True).where(F.col("kind") != WHOLE)
    # In a range the rest of an earlier record comes before the begin of a new one; kinds are numbered so.
    order = Window.partitionBy("file").orderBy("block", "kind")
    number = F.sum((F.col("kind") == BEGIN).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("number", number).groupBy("file", "name", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"), F.bool_or((F.col("kind") == BEGIN) & F.col("record").isNull()).alias("header")
    )  # a record is one field's text and more, so a handful of ranges at most
    crossing = parts.where("not header").select("name", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(fields(crossing, width))


def fields(found: DataFrame, width: int) -> DataFrame:
    """(name, fields) of records given as (name, record)."""
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("fields", T.ArrayType(T.StringType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            cuts = [cut(record, width) for record in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cuts, arrow.field(1).type)], schema=arrow)

    return found.select("name", "record").mapInArrow(run, schema)
