"""Layout of the lake and the few file-system calls that Spark has no operator for."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake import schema as SC
from alertlake.functions import exprs as X
from alertlake.functions import sky
from alertlake.operators.filters import with_day_width

#: Expected size of a bucket of staged rows. Small batches then make few files.
BUCKET_BYTES = 8 << 20

_RUN = T.StructField("run_id", T.StringType())

# Table -> schema of its files plus partition columns, so that reads need no inference.
TABLES: dict[str, T.StructType] = {
    "alerts": T.StructType(
        [
            *SC.ALERT_SCHEMA.fields,
            T.StructField("is_new_source", T.BooleanType()),
            T.StructField(sky.CELL, T.IntegerType()),
            _RUN,
            T.StructField("mjd_day", T.IntegerType()),
        ]
    ),
    "filtered": T.StructType(
        [
            T.StructField("alert_id", T.LongType()),
            T.StructField("dia_source_id", T.LongType()),
            T.StructField("filter_config", T.StringType()),
            T.StructField("filtered_at", T.TimestampType()),
            _RUN,
            T.StructField("filter_config_hash", T.StringType()),
        ]
    ),
    "materialized": T.StructType([T.StructField("filter_config_hash", T.StringType()), _RUN]),
    "layout": T.StructType([T.StructField("partition_days", T.IntegerType())]),
    "runs": SC.RUN_EVENT_SCHEMA,
    "processor_runs": SC.PROCESSOR_RUN_SCHEMA,
    "filters": SC.FILTER_LOG_SCHEMA,
}


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the JVM side."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, without a slash at the end: one name for one folder."""
    fs, p = hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def drop_directory(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.delete(p, True)


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Files right in the folder."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isFile())


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of the files below ``folder`` that Spark would read."""
    fs, p = hadoop_path(spark, folder)
    if not fs.exists(p):
        return []
    top, found, each = len(fs.makeQualified(p).toString()), [], fs.listFiles(p, True)
    while each.hasNext():
        status = each.next()
        path = status.getPath().toString()
        parts = path[top:].split("/")
        if not any(x[:1] == "." or x[:1] == "_" and "=" not in x for x in parts):
            found.append((path, status.getLen(), status.getModificationTime()))
    return sorted(found)


def drop_files(spark: SparkSession, files: list[tuple[str, int, int]]) -> None:
    """Delete the files that are still as listed, then the folders this leaves empty."""
    for path, size, changed in files:
        fs, p = hadoop_path(spark, path)
        if fs.exists(p):
            status = fs.getFileStatus(p)
            same = (status.getLen(), status.getModificationTime()) == (size, changed)
            if same and not fs.delete(p, False):
                raise OSError(f"could not delete {path}")
    for folder in {path.rsplit("/", 1)[0] for path, *_ in files}:
        fs, p = hadoop_path(spark, folder)
        if fs.exists(p) and not fs.listStatus(p):
            fs.delete(p, False)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, which appears under its name when it is whole."""
    fs, part = hadoop_path(spark, f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, hadoop_path(spark, path)[1]):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


@dataclass(frozen=True)
class Lake:
    """Tables below one root folder. Alerts are partitioned by day; a sparse table may take
    several days per partition. The widths that were written are noted in the table ``layout``,
    and what ``read`` returns carries the widest, so that windows can skip partitions.
    ``bucket_rows`` and ``merge_at`` shape the key store (``plans/store.py``)."""

    root: str
    partition_days: int = 1
    bucket_rows: int = 1_000_000
    merge_at: int = 8

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def run_path(self, table: str, run_id: str) -> str:
        return f"{self.path(table)}/run_id={run_id}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table, empty if nothing was written yet."""
        if not exists(spark, self.path(table)):
            return spark.createDataFrame([], TABLES[table])
        if table == "alerts":
            return self._alerts(spark)
        return spark.read.schema(TABLES[table]).parquet(self.path(table))

    def _alerts(self, spark: SparkSession) -> DataFrame:
        """Folders of runs, and of compactions in place of the runs that they hold."""
        from alertlake.plans import compaction

        found, kind = compaction.manifest(spark, self), TABLES["alerts"]
        if found.folders:
            paths = [self.run_path("alerts", r) for r in compaction.live_runs(spark, self)]
            rows = compaction.read_compacted(spark, self, found)
            if paths:
                runs = spark.read.schema(kind).option("basePath", self.path("alerts")).parquet(*paths)
                rows = rows.select(*kind.fieldNames()).union(runs.select(*kind.fieldNames()))
        else:
            rows = spark.read.schema(kind).parquet(self.path("alerts"))
        width = self.day_width(spark)
        return rows if width is None else with_day_width(rows, width)

    def day_width(self, spark: SparkSession) -> int | None:
        """The widest day partition that was noted; None if a table was written without a note."""
        if not exists(spark, self.path("layout")):
            return None
        return self.read(spark, "layout").agg(F.max("partition_days")).first()[0]

    def note_day_width(self, spark: SparkSession) -> None:
        """Before alerts are written: keep the width, unless the alerts are older than notes."""
        known = self.day_width(spark)
        unnoted = known is None and exists(spark, self.path("alerts"))
        if not unnoted and (known is None or known < self.partition_days):
            self.append_row(spark, "layout", {"partition_days": self.partition_days})

    def append_row(self, spark: SparkSession, table: str, row: dict) -> None:
        """One log row; logs are small and read as latest-per-key."""
        self.append_rows(spark, table, [row])

    def append_rows(self, spark: SparkSession, table: str, rows: list[dict]) -> None:
        kind = TABLES[table]
        values = [tuple(row.get(n) for n in kind.fieldNames()) for row in rows]
        spark.createDataFrame(values, kind).coalesce(1).write.mode("append").parquet(
            self.path(table)
        )


def write_by_day(
    alerts: DataFrame, path: str, mode: str = "overwrite", partition_days: int = 1
) -> None:
    """Write partitioned by ``mjd_day``. The rebalance lets AQE split a crowded day over
    tasks and join sparse days in one, so neither giant nor tiny files come out; rows are
    sorted by sky cell inside the files, and by source inside a cell, which makes their min/max
    statistics selective. Rows without a position have no cell."""
    placed = {"ra", "dec"} <= set(alerts.columns)
    cell = {sky.CELL: sky.sky_cell(F.col("ra"), F.col("dec"))} if placed else {}
    (
        alerts.withColumn("mjd_day", X.mjd_day("mjd", partition_days))
        .hint("rebalance", "mjd_day")
        .withColumns(cell)
        .sortWithinPartitions("mjd_day", *cell, "dia_source_id", "mjd")
        .write.mode(mode)
        .partitionBy("mjd_day")
        .parquet(path)
    )


@contextmanager
def bucketed(rows: DataFrame, path: str, keys: Sequence[str]) -> Iterator[DataFrame]:
    """``rows`` written below ``path`` in buckets of ``keys``: one for each ``BUCKET_BYTES`` of the size
    that Spark expects of them, at most as many as a shuffle has partitions. Each task cuts its own rows,
    so nothing is shuffled, and what is grouped or joined by ``keys`` afterwards needs no shuffle either.
    Files for all buckets are open at once: rows would be sorted otherwise. The table's name is known
    inside the block only."""
    spark, name, writers = rows.sparkSession, f"bucketed_{uuid.uuid4().hex}", "spark.sql.maxConcurrentOutputFileWriters"
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    buckets = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BUCKET_BYTES)))
    before = spark.conf.get(writers)
    spark.conf.set(writers, str(buckets))
    try:
        (
            rows.write.format("parquet")
            .options(path=path, compression="zstd")
            .bucketBy(buckets, *keys)
            .saveAsTable(name)
        )
    finally:
        spark.conf.set(writers, before)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_by_day(spark: SparkSession, path: str, partition_days: int) -> DataFrame:
    """A table of ``write_by_day`` with its width noted, so that windows skip partitions."""
    return with_day_width(spark.read.parquet(path), partition_days)


def count_rows(rows: DataFrame) -> int:
    return rows.agg(F.count(F.lit(1))).first()[0]
