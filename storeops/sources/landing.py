"""CSV extracts landed as text, with file name and load time on every row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.fixed_values import EXPECTED_LOADS
from storeops.sources.tables import literal_rows
from storeops.schemas import EXTRACTS, FILE_PATTERNS, text_schema
from storeops.sources import quoted_csv

CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def land_extract(
    spark: SparkSession,
    folder: str,
    extract: str,
    pattern: str | None = None,
    loaded_at: datetime | None = None,
    multiline: bool = True,
    path_regex: str | None = None,
) -> DataFrame:
    """All files of one extract as an all-text table.

    Columns bind by position, the header line is skipped, an empty field is NULL, spaces stay, and gzip is read as
    is, also below subfolders. Files are picked by a glob on their name (`pattern`), or by a regular expression that
    must match the whole path below the folder (`path_regex`); a pick without any file is an empty table. Line breaks
    inside quotes belong to the field; files are split all the same, after a scan for the ranges that begin inside
    quotes. `multiline` off saves that scan for files known to hold none. Gzip files cannot be split: for large loads
    deliver them in many parts.
    """
    paths: list[str] | str = folder
    glob = pattern or FILE_PATTERNS[extract]
    if path_regex is not None:
        paths, glob = matching_paths(spark, folder, path_regex), None
    if not paths:
        rows = spark.createDataFrame([], text_schema(extract)).withColumn("_source_file", F.lit(None).cast("string"))
    elif multiline:
        names = EXTRACTS[extract]
        found = quoted_csv.read(spark, paths, glob, len(names))
        rows = found.select(*[F.get("fields", F.lit(i)).alias(n) for i, n in enumerate(names)], F.col("name").alias("_source_file"))
    else:
        reader = spark.read.schema(text_schema(extract)).options(**CSV_OPTIONS, header="true", enforceSchema="true", recursiveFileLookup="true")
        reader = reader if glob is None else reader.option("pathGlobFilter", glob)
        rows = reader.csv(paths).select(*EXTRACTS[extract], F.col("_metadata.file_name").alias("_source_file"))
    return rows.select(*EXTRACTS[extract], "_source_file", F.lit(loaded_at or datetime.now()).alias("_loaded_at"))


def land_all(
    spark: SparkSession, folder: str, loaded_at: datetime | None = None, multiline: bool | Mapping[str, bool] = True
) -> dict[str, DataFrame]:
    """The eleven extracts, stamped with one load time; `multiline` may be told per extract, the others have it on."""
    stamp = loaded_at or datetime.now()
    told = {name: multiline for name in EXTRACTS} if isinstance(multiline, bool) else multiline
    return {name: land_extract(spark, folder, name, loaded_at=stamp, multiline=told.get(name, True)) for name in EXTRACTS}


def matching_paths(spark: SparkSession, folder: str, regex: str) -> list[str]:
    """The files below a folder whose path from there on matches a regular expression as a whole.

    Only the file system's listing is read. The driver holds the paths, as it does for any scan.
    """
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toUri().getPath().rstrip("/") + "/"
    below = F.substring_index(F.regexp_replace("path", "^[a-z0-9]+:(?://[^/]*)?", ""), root, -1)
    listed = list_landing_files(spark, folder).where(below.rlike(f"^(?:{regex})$"))
    return [r["path"] for r in listed.select("path").collect()]


def list_landing_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of the files below the landing folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    files = reader.load(folder)
    return files.select("path", F.col("length").alias("size_bytes"), "modificationTime").orderBy("path")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, in the given order of tables."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        raise ValueError("no tables given")
    return counts


def manifest_check(
    tables: Mapping[str, DataFrame], expected: Sequence[tuple[str, int]] | DataFrame = tuple(EXPECTED_LOADS)
) -> DataFrame:
    """Loaded against expected rows per table, OK or CHECK UPLOAD.

    Names are matched in lower case. A table that did not load, or that nobody expects, needs a check too.
    """
    loaded = row_counts(tables).select(F.lower("table_name").alias("table_name"), F.col("row_count").alias("loaded_rows"))
    if not isinstance(expected, DataFrame):
        expected = literal_rows(loaded.sparkSession, expected, "table_name", "expected_rows")
    expected = expected.select(F.lower("table_name").alias("table_name"), "expected_rows")
    return (
        loaded.join(expected, "table_name", "full")
        .select(
            "table_name",
            "loaded_rows",
            "expected_rows",
            F.when(F.col("loaded_rows") == F.col("expected_rows"), "OK").otherwise("CHECK UPLOAD").alias("status"),
        )
        .orderBy("table_name")
    )
