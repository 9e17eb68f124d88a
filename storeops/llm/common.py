"""Helpers shared by the operators: reading tables, per-text Arrow passes, tables between steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE = 256

#: Bytes of text in such a slice, where an operator cuts by size; a longer text is a slice of its own.
SLICE_BYTES = 8 << 20

#: Bytes A-Z to a-z; all other bytes of a UTF-8 text stay.
ASCII_LOWER = bytes(range(256)).lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """An unused path below spark.checkpoint.dir, which all executors share.

    Where that is not set, a local session uses a temporary folder of its machine and a cluster refuses. The
    application's folder goes when its session ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    own = f"{root.rstrip('/')}/corpus-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that `written` makes meanwhile are deleted at the end, unless they are lasting ones."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for name in _SCRATCH.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, purpose: str, lasting: bool = False) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts the lineage, survives lost executors, and gives the joins that follow a size they can trust.
    """
    path = work_folder(df.sparkSession, purpose)
    if _SCRATCH and not lasting:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks_of(items: DataFrame, size: Column, most: int) -> Iterator[list[Row]]:
    """The rows in blocks of about `most` of the summed `size`, one at a time, equal rows together.

    The driver holds a block at a time, whatever the table's size. No rows: one empty block.
    """
    count = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // most))
    number = F.pmod(F.xxhash64(*items.columns), F.lit(count))
    for k in range(count):
        yield items.where(number == k).collect()


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most SLICE rows and about SLICE_BYTES bytes of the text in `column`."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start == SLICE or total + size > SLICE_BYTES):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no classifier learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def map_texts(
    docs: DataFrame,
    keep: list[str],
    schema: str,
    worker: Callable[[], Callable[[list[bytes]], list]],
    text: str = "text",
) -> DataFrame:
    """Columns `keep` beside what a function makes of the UTF-8 texts, a few hundred at a time.

    `worker` runs once per task and returns the function; that gets texts (null: empty) and returns one
    list or array for each further column of `schema`. Whole texts go in, one row comes out per row.
    """
    frame = docs.select(*keep, F.col(text).alias("_text"))
    types = frame.sparkSession.createDataFrame([], schema).schema
    full = frame.drop("_text").schema
    for field in types:
        full = full.add(field.name, field.dataType, True)
    arrow = to_arrow_schema(full)
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = worker()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                piece = batch.slice(start, SLICE)
                texts = [x or b"" for x in piece.column(width).cast(pa.binary()).to_pylist()]
                made = function(texts)
                columns = [piece.column(i) for i in range(width)]
                columns += [pa.array(x, type=arrow.field(width + i).type) for i, x in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return frame.mapInArrow(run, full)
