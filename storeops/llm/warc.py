"""WARC archives: written with revisit records, read back in splits by verified chains of record offsets.

A split cannot know whether a magic it sees starts a record or stands inside a payload. Each task emits its
candidates, each with the offset of the record that would follow. Only the chain that starts at a file's
first byte is real; pointer jumping over the splits' entries finds it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from storeops.llm.common import table, work_folder, written

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
#: Payloads of at least this many bytes are deduplicated.
LEAST_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

_BASE32HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: twenty bits at a time by change of number base."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * g + 1, 5), 16, 32), 4, "0") for g in range(8)]
    return F.translate(F.concat(*groups), _BASE32HEX, _BASE32)


_KEY = ["page_id", "sum", "bytes"]


def _payload_key(payload: str) -> list[Column]:
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    return [F.sha2(body, 256).alias("sum"), F.octet_length(body).alias("bytes")]


def plan_records(pages: DataFrame, page_id: str, payload: str, least: int) -> DataFrame:
    """(page_id, sum, bytes, refers_to) of the pages whose payload an earlier page already has.

    Only digests and lengths are grouped. Pages with a null id are always responses.
    """
    keys = pages.select(F.col(page_id).alias("page_id"), *_payload_key(payload))
    keys = keys.where(F.col("bytes") >= least)
    firsts = keys.groupBy("sum", "bytes").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    later = keys.join(firsts, ["sum", "bytes"]).where("page_id <> refers_to")
    return written(later.select(*_KEY, "refers_to").distinct(), "revisits")


def write_warc(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_BYTES
) -> None:
    """Write one record per page, the payload as an HTTP response in UTF-8 (null: empty).

    Of records with equal payloads of at least `least` bytes that with the smallest id is the response, the
    others are revisits without a payload. Records end with two line breaks, which is the text writer's line
    separator; so the archives are written by Spark, a file per task. Null urls give no target header, line
    breaks in urls are escaped. Rows that share an id are records of their own: each is a revisit or a response by
    its own payload, and a revisit's digest tells which of several records of an id it refers to.
    """
    revisits = plan_records(pages, page_id, payload, least)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("body"), *_payload_key(payload))
    responses = rows.join(revisits.select(*_KEY), _KEY, "left_anti").select("*", F.lit(None).cast("long").alias("refers_to"))
    again = rows.join(revisits, _KEY).withColumnRenamed("refers_to", "to")
    again = again.select("page_id", "url", "body", F.col("to").alias("refers_to"))
    every = responses.select("page_id", "url", "body", "refers_to").unionByName(again)
    every.select(_record().alias("value")).write.option("lineSep", END.decode()).text(path)


def _record() -> Column:
    revisit = F.col("refers_to").isNotNull()
    body = F.col("body")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(body))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def urn(number: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))

    safe = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(MAGIC.decode()),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", safe),
        line("WARC-Refers-To", urn(F.col("refers_to"))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(body.cast("binary")))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def _headers(segment: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Header fields in lower case and the bytes up to the block; None if this is no record's head."""
    stop = segment.find(END)
    if stop < 0:
        return None
    fields = {}
    for line in segment[:stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not fields.get(b"content-length", b"").isdigit():
        return None
    return fields, stop + len(END)


CANDIDATE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("bytes", T.LongType()),  # of the whole split, in its closing row; else null
        T.StructField("at", T.LongType()),
        T.StructField("next", T.LongType()),
        T.StructField("leaves", T.LongType()),
        T.StructField("payload_at", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("told_digest", T.StringType()),  # the head's, of the full payload also where it is a revisit
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


class _Split:
    """The segments of one split in order; offsets count from its first magic (or the file's first byte)."""

    def __init__(self, file: str, block: int, payload: bool):
        self.file, self.block, self.payload = file, block, payload
        self.at, self.first = 0, block == 0
        self.found: list[list] = []
        self.open: list[tuple[int, int, int]] = []  # row, payload start, payload end
        self.held: list[tuple[int, bytes]] = []

    def add(self, segment: bytes) -> None:
        if self.first:  # what comes before the file's first magic
            self.first, self.at = False, len(segment)
            return
        at, data = self.at, MAGIC + segment
        self.at += len(data)
        if self.open:
            self.held.append((at, data))
        head = _headers(segment)
        if head is not None:
            fields, size = head
            begin = at + len(MAGIC) + size
            end = begin + int(fields[b"content-length"])
            start = begin
            if fields.get(b"content-type", b"").startswith(b"application/http"):
                stop = data.find(END, begin - at)
                start = at + stop + len(END) if stop >= 0 and at + stop + len(END) <= end else begin
            text = [fields.get(n, b"").decode("utf-8", "replace") or None for n in (b"warc-type", b"warc-record-id", b"warc-refers-to", b"warc-target-uri", b"warc-payload-digest")]
            self.found.append([self.file, self.block, None, at, end + len(END), None, start, *text, end - start, None, None])
            if end <= self.at:
                self._digest(-1, data[start - at : end - at])
            else:
                if not self.open:
                    self.held = [(at, data)]
                self.open.append((len(self.found) - 1, start, end))
        if self.open and any(end <= self.at for _, _, end in self.open):
            joined, origin = b"".join(d for _, d in self.held), self.held[0][0]
            for row, start, end in self.open:
                if end <= self.at:
                    self._digest(row, joined[start - origin : end - origin])
            self.open = [o for o in self.open if o[2] > self.at]
            if not self.open:
                self.held = []

    def _digest(self, row: int, data: bytes) -> None:
        self.found[row][-2] = base64.b32encode(hashlib.sha1(data).digest()).decode()
        self.found[row][-1] = data if self.payload else None

    def rows(self) -> list[list]:
        """The candidates with the offset at which their chain leaves the split, and the closing row."""
        leaves: dict[int, int | None] = {}
        for row in reversed(self.found):
            leaves[row[3]] = row[5] = row[4] if row[4] >= self.at else leaves.get(row[4])
        return [*self.found, [self.file, self.block, self.at, *[None] * 12]]


def segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the bytes between magics, in order within each split of each file."""
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    lines = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return lines.select(*place, F.col("value").cast("binary").alias("value"))


def candidates(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """What each split of the archives can tell by itself (CANDIDATE), offsets counted within the split.

    Spark's text reader cuts the files at each magic, so a split has the segments that begin in it, in order.
    """
    lines = segments(spark, path)
    arrow = to_arrow_schema(CANDIDATE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[list]) -> Iterator[pa.RecordBatch]:
            step = 256 if payload else 8192
            for i in range(0, len(rows), step):
                columns = zip(*rows[i : i + step])
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

        split = None
        for batch in batches:
            for file, block, value in zip(*(batch.column(i) for i in range(3))):
                file, block = file.as_py(), block.as_py()
                if split is None or (split.file, split.block) != (file, block):
                    if split is not None:
                        yield from out(split.rows())
                    split = _Split(file, block, payload)
                split.add(value.as_py())
        if split is not None:
            yield from out(split.rows())

    return lines.mapInArrow(run, CANDIDATE)


def placed(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates with offsets in their file, and (file, block, begin, bytes) of the splits."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = found.where("bytes is not null").select("file", "block", "bytes")
    splits = splits.withColumn("begin", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    rows = found.where("bytes is null").drop("bytes").join(splits.select("file", "block", "begin"), ["file", "block"])
    for name in ("at", "next", "leaves", "payload_at"):
        rows = rows.withColumn(name, F.col(name) + F.col("begin"))
    return rows.drop("begin"), splits


def reachable(rows: DataFrame) -> DataFrame:
    """(file, at) of the candidates on the chain from each file's first byte.

    First over splits: a node is a candidate at which some chain enters a split, its pointer the offset where
    the chain leaves. Each round doubles the pointers' reach, so the rounds grow with the logarithm of a
    file's splits. Then each entered split follows its own chain.
    """
    entries = rows.select("file", F.col("leaves").alias("at")).where("at is not null").distinct()
    starts = rows.where("at = 0").select("file", "at")
    nodes = rows.select("file", "block", "at", "leaves").join(entries.union(starts).distinct(), ["file", "at"])
    nodes = written(nodes, "entries")
    reach = written(nodes.where("at = 0").select("file", "at"), "reach")
    jump = written(nodes.where("leaves is not null").select("file", "at", F.col("leaves").alias("to")), "jump")
    known = nodes.select("file", F.col("at").alias("to"))
    jump = written(jump.join(known, ["file", "to"]).select("file", "at", "to"), "jump")
    while not jump.isEmpty():
        ahead = reach.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reach = written(reach.union(ahead).distinct(), "reach")
        second = jump.select("file", F.col("at").alias("to"), F.col("to").alias("end"))
        jump = written(jump.join(second, ["file", "to"]).select("file", "at", F.col("end").alias("to")), "jump")
    entered = nodes.join(reach, ["file", "at"]).select("file", "block", "at")

    def follow(entry: pa.Table, inside: pa.Table) -> pa.Table:
        after = dict(zip(inside["at"].to_pylist(), inside["next"].to_pylist()))
        real: set[int] = set()
        for at in entry["at"].to_pylist():
            while at in after and at not in real:
                real.add(at)
                at = after[at]
        files = [entry["file"][0].as_py()] * len(real) if real else []
        return pa.table({"file": pa.array(files, pa.string()), "at": pa.array(sorted(real), pa.int64())})

    return (
        entered.groupBy("file", "block")
        .cogroup(rows.select("file", "block", "at", "next").groupBy("file", "block"))
        .applyInArrow(follow, "file string, at long")
    )


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of the archives below `path`.

    file, at (offset), next, record_type, record_id, refers_to, uri, told_digest (as the head spells it),
    payload_bytes, payload_digest (bare base32 SHA-1 of the payload as read) and, if asked for, the payload. A magic inside a payload yields no
    record, also where the payload reaches over splits. What comes after a broken record of a file is not
    reached. Empty archives give no rows.
    """
    found = candidates(spark, path, payload)
    if not payload:
        found = written(found, "candidates")
    rows, splits = placed(found)
    real = written(reachable(rows), "reachable")
    records = rows.join(real, ["file", "at"])
    across = written(records.where("payload_digest is null").select("file", "at", "payload_at", "next"), "across")
    if not across.isEmpty():
        pieces = _assembled(spark, path, across, splits)
        if not payload:
            pieces = pieces.withColumn("payload", F.lit(None).cast("binary"))
        records = records.join(pieces.select("file", "at", F.col("digest").alias("_digest"), F.col("payload").alias("_payload")), ["file", "at"], "left")
        records = records.withColumn("payload_digest", F.coalesce("payload_digest", "_digest")).withColumn("payload", F.coalesce("payload", "_payload"))
    columns = ["file", "at", "next", "record_type", "record_id", "refers_to", "uri", "told_digest", "payload_bytes", "payload_digest"]
    return records.select(*columns, *(["payload"] if payload else []))


def _assembled(spark: SparkSession, path: str, across: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, at, payload, digest) of records whose payload, by magics inside it, reaches into later splits.

    At most one real record does so at the end of each split. Only the splits concerned are read for it.
    """
    lines = segments(spark, path)
    schema = T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("from", T.LongType()), T.StructField("data", T.BinaryType())]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for batch in batches:
            files, blocks, values = (batch.column(i).to_pylist() for i in range(3))
            begins, data = [], []
            for file, block, value in zip(files, blocks, values):
                fresh = (file, block) != now
                if fresh:
                    now, at = (file, block), 0
                part = value if fresh and block == 0 else MAGIC + value
                begins.append(at)
                data.append(part)
                at += len(part)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(begins, type=pa.int64()), pa.array(data, type=pa.binary())], schema=arrow)

    ends = splits.withColumn("end", F.col("begin") + F.col("bytes")).select("file", "block", "begin", "end")
    wanted = across.join(ends, "file").where((F.col("begin") < F.col("next")) & (F.col("end") > F.col("at")))
    wanted = written(wanted, "wanted")
    parts = lines.mapInArrow(run, schema).join(wanted, ["file", "block"])
    begin = F.col("begin") + F.col("from")
    parts = parts.where((begin < F.col("next")) & (begin + F.octet_length("data") > F.col("at")))
    whole = parts.groupBy("file", "at", "payload_at", "next").agg(
        F.array_sort(F.collect_list(F.struct(begin.alias("begin"), F.col("data").alias("data")))).alias("parts")
    )
    joined = F.aggregate("parts", F.lit("").cast("binary"), lambda a, p: F.concat(a, p["data"]))
    skip = F.col("payload_at") - F.col("parts")[0]["begin"]
    size = F.col("next") - len(END) - F.col("payload_at")
    body = F.substring(joined, (skip + 1).cast("int"), size.cast("int"))
    return whole.select("file", "at", body.alias("payload")).withColumn("digest", base32_sha1(F.col("payload")))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = written(read_warc(spark, path), "records")

    def number(urn: str) -> Column:
        return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    records = records.withColumn("page_id", number("record_id")).withColumn("to", number("refers_to"))
    own = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = records.where("record_type = 'response'").select(*own, F.lit(None).cast("long").alias("refers_to"))
    originals = responses.select(F.col("page_id").alias("to"), "payload_bytes", "payload_digest").distinct()
    told = F.regexp_replace("told_digest", "^sha1:", "").alias("payload_digest")
    revisits = records.where("record_type = 'revisit'").select("page_id", "record_type", "to", told).join(originals, ["to", "payload_digest"])
    return responses.unionByName(revisits.select(*own, F.col("to").alias("refers_to")))


#: The same rows from the pages alone.
OP1_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
    SELECT n, h, min(page_id) AS first_id FROM p GROUP BY n, h
)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)), '')
           AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (n, h)
"""
