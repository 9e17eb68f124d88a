"""Writing, appending, exporting and staging tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import Future
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.functions.columns import in_days

CHECKPOINT_DIR = "spark.checkpoint.dir"

# The folder columns of tables laid out by month and of logs, and the name of a table's version marks.
MONTH = "year_month"
RUN = "run"
LIVE = "_live"


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], *names: str) -> DataFrame:
    """A short fixed list as a frame whose size the optimizer knows.

    A frame made from Python objects has no size estimate and would never be broadcast.
    """

    def literal(value) -> str:
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _children(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies right below a folder; none if there is no such folder."""
    files, place = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(place)) if files.exists(place) else []


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """The versions of a table that were written to their end, the oldest first."""
    marks = [name.split(".", 2) for name in _children(spark, path) if name.startswith(f"{LIVE}.")]
    return sorted((int(number), version) for _, number, version in marks)


def live_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are: its newest version, or the folder itself if it was written as a plain one."""
    versions = _versions(spark, path)
    return f"{path}/{versions[-1][1]}" if versions else path


# Spark's setting that deletes the shuffle files of a query as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING: dict[str, tuple[int, str | None]] = {}
_CLEANUP_LOCK = Lock()


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind.

    Written rows are read from their files, so nothing asks for the shuffles again. Else they stay until the driver
    happens to collect its garbage, and the shuffles of all tables of a plan add up on the executors' disks. The
    setting belongs to the session, so the last of several writers at a time puts it back.
    """
    session = spark.sparkContext.applicationId + str(spark._jsparkSession.sessionUUID())
    with _CLEANUP_LOCK:
        writers, before = _WRITING.get(session, (0, None))
        if not writers:
            before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _WRITING[session] = (writers + 1, before)
    try:
        yield
    finally:
        with _CLEANUP_LOCK:
            writers, before = _WRITING.pop(session)
            if writers > 1:
                _WRITING[session] = (writers - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def _write(df: DataFrame, path: str, month_of: str | None) -> None:
    if month_of is not None:
        df = df.withColumn(MONTH, F.date_format(month_of, "yyyy-MM")).hint("rebalance", MONTH)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    with _shuffles_freed(df.sparkSession):
        (writer if month_of is None else writer.partitionBy(MONTH)).parquet(path)


def write_table(df: DataFrame, path: str, month_of: str | None = None) -> DataFrame:
    """Replace the table at `path` in one step and return it as read back.

    `month_of` names a date column: the table is then laid out in one folder per month. The rebalance hint lets
    adaptive execution cut a heavy month into several files. The rows go to a folder of their own, which counts once
    its mark is there; making the mark is the only step that others see. A write that fails leaves the table as it
    was, and readers keep the version they opened: the one before stays until the next write. Of two writers at a
    time one fails.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    before = _versions(spark, path)
    number = before[-1][0] + 1 if before else 1
    version = f"data-{number:08d}-{uuid.uuid4().hex}"
    _write(df, f"{path}/{version}", month_of)
    files, mark = _file_system(spark, f"{path}/{LIVE}.{number:08d}.{version}")
    if any(n >= number for n, _ in _versions(spark, path)) or not files.createNewFile(mark):
        raise RuntimeError(f"another writer has replaced {path} meanwhile")
    for number, old in before[:-1]:
        for name in (f"{LIVE}.{number:08d}.{old}", old):
            files.delete(_file_system(spark, f"{path}/{name}")[1], True)
    return spark.read.schema(df.schema).parquet(f"{path}/{version}").select(*df.columns)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that `write_table` has written."""
    rows = spark.read.parquet(live_path(spark, path))
    return rows.drop(MONTH)


def read_days(spark: SparkSession, path: str, day: str, start: str, end: str | None) -> DataFrame:
    """The rows of a table laid out by month whose `day` lies in a closed range; `end` may be open.

    The month is filtered along with the day, so only the folders of those months are opened.
    """
    wanted = (F.col(MONTH) >= start[:7]) & in_days(F.col(day), start, end)
    if end is not None:
        wanted = wanted & (F.col(MONTH) <= end[:7])
    return spark.read.parquet(live_path(spark, path)).filter(wanted).drop(MONTH)


def append_log(df: DataFrame, path: str, run_at: str = "run_at") -> DataFrame:
    """Add the rows of a run to a history table, created on first use, and return all of it.

    Each run has a folder named by its time stamp. A run that is repeated, after a failure or by a retry, replaces
    its own folder and so is in the history once.
    """
    runs = df.withColumn(RUN, F.date_format(run_at, "yyyyMMdd'T'HHmmssSSSSSS"))
    runs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)
    return _log(df.sparkSession, path).select(*df.columns)


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a history's newest run. It is found by the folders' names, and only that folder is read."""
    runs = [name for name in _children(spark, path) if name.startswith(f"{RUN}=")]
    return spark.read.parquet(f"{path}/{max(runs)}" if runs else path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, ISO dates, and text exactly as it is, outer spaces included."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An exported CSV with typed columns and parsed dates."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the one all executors share; it goes when the session ends."""
    root = spark.conf.get(CHECKPOINT_DIR, "")
    if not root:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = f"{root.rstrip('/')}/storeops-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark)}/{purpose}/{uuid.uuid4().hex}"


_STAGED: dict[tuple[str, str], Future] = {}
_LOCK = Lock()


def stage(df: DataFrame, key: str, month_of: str | None = None) -> DataFrame:
    """Write a table that several later steps read to the shared folder and read it back.

    A key is written once per session; who stages it again gets the written table, also while another
    thread still writes it. Keys name the source and the table, so one key always means the same rows. The
    files survive lost executors, are read with column pruning, and carry real size statistics for joins.
    """
    spark = df.sparkSession
    with _LOCK:
        name = (spark.sparkContext.applicationId, key)
        done = _STAGED.get(name)
        mine = done is None
        if mine:
            done = _STAGED[name] = Future()
    if mine:
        try:
            path = new_folder(spark, "stage")
            _write(df, path, month_of)
            done.set_result(path)
        except BaseException as error:
            _STAGED.pop(name, None)
            done.set_exception(error)
            raise
    return spark.read.schema(df.schema).parquet(done.result()).select(*df.columns)


def staged_path(spark: SparkSession, key: str) -> str:
    """Where a table staged in this session lies."""
    return _STAGED[spark.sparkContext.applicationId, key].result()
