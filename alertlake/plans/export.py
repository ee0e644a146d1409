"""Sinks: exports, daily append, split, merge, conversion, retention."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.functions import exprs as X
from alertlake.operators import aggregates, dedupe, sets, views
from alertlake.plans import storage
from alertlake.sources.files import read_csv_text

FORMATS = ("csv", "parquet", "json")


def text_columns(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for CSV."""
    nested = (T.MapType, T.ArrayType, T.StructType)
    changed = {f.name: F.to_json(f.name) for f in rows.schema if isinstance(f.dataType, nested)}
    return rows.withColumns(changed) if changed else rows


def export(
    rows: DataFrame, path: str, fmt: str = "csv", *, single_file: bool = False, mode="overwrite", **options: str
) -> str:
    """A folder of part files, written by all tasks; one file only on request (small data). ``options``
    go to the writer, such as ``compression="gzip"`` for texts."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known: {', '.join(FORMATS)}")
    out = text_columns(rows) if fmt == "csv" else rows
    writer = (out.coalesce(1) if single_file else out).write.mode(mode)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    writer.options(**options).format(fmt).save(path)
    return path


def dated_name(stem: str, fmt: str, as_of: datetime | None = None) -> str:
    moment = as_of or datetime.now(timezone.utc)
    return f"{stem}_{moment:%Y%m%d}.{fmt}"


def named_export(
    what: str,
    alerts: DataFrame,
    folder: str,
    fmt: str = "csv",
    *,
    as_of: datetime | None = None,
    results: DataFrame | None = None,
    days: float = 7,
    processor: str | None = None,
    sql: str | None = None,
    params: list | None = None,
) -> str:
    """today, recent, minimoon, results, sso_summary or custom, under a dated name."""
    makers = {
        "today": lambda: views.today_ingest(alerts, as_of),
        "recent": lambda: views.recent(alerts, days, as_of),
        "minimoon": lambda: views.minimoon_candidates(alerts),
        "results": lambda: views.processing_results(results, processor, None),
        "sso_summary": lambda: aggregates.sso_summary(alerts),
        "custom": lambda: views.custom(alerts.sparkSession, sql, params),
    }
    if what not in makers:
        raise ValueError(f"unknown export {what!r}; known: {', '.join(makers)}")
    return export(makers[what](), f"{folder.rstrip('/')}/{dated_name(what, fmt, as_of)}", fmt)


def append_daily(rows: DataFrame, path: str, moment: Column | None = None, fmt="parquet") -> None:
    """Append below year=/month=/day= of ``moment`` (default: the ingest time)."""
    at = F.col("ingested_at") if moment is None else moment
    dated = rows.withColumns(
        {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)}
    ).hint("rebalance", "year", "month", "day")
    out = text_columns(dated) if fmt == "csv" else dated
    writer = out.write.mode("append").partitionBy("year", "month", "day")
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    writer.format(fmt).save(path)


def split_by_value(rows: DataFrame, column: str, path: str, fmt: str = "csv") -> str:
    """One folder per value (null left out), its name made safe; the column stays in the rows."""
    if column not in rows.columns:
        raise ValueError(f"no column {column!r}")
    label = f"{column}_value"
    tagged = rows.where(F.col(column).isNotNull()).withColumn(label, X.partition_safe(column))
    out = text_columns(tagged).hint("rebalance", label)
    writer = out.write.mode("overwrite").partitionBy(label)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    writer.format(fmt).save(path)
    return path


def merge_csv(
    spark: SparkSession,
    inputs: Sequence[str],
    path: str,
    *,
    dedupe_column: str | None = None,
    remove_duplicates: bool = False,
    sort_by: str | Sequence[str] | None = None,
) -> int:
    """Merge CSV files of possibly different columns; returns the rows written.

    "First" among duplicates is the first in input order: file by file, as listed (the files of
    a folder by name).
    """
    found = [p for p in inputs if storage.exists(spark, p)]
    if not found:
        return 0
    parts = [
        read_csv_text(spark, p).withColumns(
            {
                "_file": F.lit(i),
                "_path": F.col("_metadata.file_path"),
                "_block": F.col("_metadata.file_block_start"),
                "_row": F.monotonically_increasing_id(),
            }
        )
        for i, p in enumerate(found)
    ]
    # Spark packs and orders files by size; a block is read in order by one task.
    order = ["_file", "_path", "_block", "_row"]
    merged = sets.concat_differing(parts)
    if dedupe_column and dedupe_column in merged.columns:
        merged = dedupe.dedupe_by_column(merged, dedupe_column, order)
    merged = merged.drop(*order)
    if remove_duplicates and not (dedupe_column and dedupe_column in merged.columns):
        merged = dedupe.dedupe_by_column(merged, None)
    for_order = [sort_by] if isinstance(sort_by, str) else list(sort_by or [])
    if for_order:
        # The columns are text: numbers sort as numbers, missing values last.
        merged = merged.orderBy(
            *[
                key
                for c in for_order
                for key in (
                    F.col(c).try_cast("double").asc_nulls_last(),
                    F.col(c).asc_nulls_last(),
                )
            ]
        )
    export(merged, path, "csv")
    return storage.count_rows(spark.read.options(header=True, escape='"').csv(path))


def csv_to_json(spark: SparkSession, source: str, path: str) -> str:
    return export(read_csv_text(spark, source), path, "json")


# --- retention --------------------------------------------------------------------------------

RETENTION_DAYS = {"csv": 90, "cutouts": 30}  # fixed values: defaults per kind of data


def expired_days(
    spark: SparkSession,
    path: str,
    days: int,
    as_of: date | None = None,
    partition_days: int = 1,
) -> list[str]:
    """Partitions (``year=/month=/day=`` or ``mjd_day=``) all of whose days are older than
    ``days``."""
    limit = (as_of or datetime.now(timezone.utc).date()) - timedelta(days=days)
    old = []
    for top in storage.subdirectories(spark, path):
        leaf = top.rsplit("/", 1)[-1]
        if leaf.startswith("mjd_day="):
            day = date(1858, 11, 17) + timedelta(
                days=int(leaf.split("=")[1]) + partition_days - 1
            )
            old += [top] if day < limit else []
        elif leaf.startswith("year="):
            for month in storage.subdirectories(spark, top):
                for folder in storage.subdirectories(spark, month):
                    y, m, d = (int(p.split("=")[1]) for p in folder.split("/")[-3:])
                    old += [folder] if date(y, m, d) < limit else []
    return old


def expire(
    spark: SparkSession,
    path: str,
    days: int,
    *,
    fmt: str = "parquet",
    archive: str | None = None,
    as_of: date | None = None,
    dry_run: bool = True,
    partition_days: int = 1,
) -> list[str]:
    """Drop old day partitions, after copying them below ``archive`` if one is given.

    A dry run, the default, only lists them. Each expiry has a folder ``expiry_id=`` of its own in
    the archive, named by the source folder and by the files it moves, so late rows of an expired
    day and other sources are added to an archive and replace nothing in it. The files of an
    expiry are noted once their copy is whole, and only noted files are deleted. What broke off
    is settled by the next expiry of the same source, on whatever day: a copy without a note is
    dropped, since all its rows are live, and noted files that are still live are deleted. One
    expiry of a source runs at a time.
    """
    if dry_run:
        return expired_days(spark, path, days, as_of, partition_days)
    if archive is None:
        old = expired_days(spark, path, days, as_of, partition_days)
        for folder in old:
            storage.drop_directory(spark, folder)
        return old
    root = archive.rstrip("/")
    source = storage.qualified(spark, path)
    prefix = hashlib.sha256(source.encode()).hexdigest()[:16]
    _settle(spark, root, prefix)
    old = expired_days(spark, path, days, as_of, partition_days)
    files = [f for folder in old for f in storage.data_files(spark, folder)]
    if files:
        names = json.dumps({"source": source, "files": files})
        # A letter in front: partition values of digits only would be read as numbers.
        expiry = f"x{prefix}-{hashlib.sha256(names.encode()).hexdigest()[:32]}"
        # One job copies all of them, partition columns and layout kept.
        columns = [p.split("=")[0] for p in old[0].split("/") if "=" in p]
        kept = [c for c in columns if c in ("mjd_day", "year", "month", "day")]
        rows = spark.read.option("basePath", source).format(fmt)
        if fmt == "csv":
            rows = rows.option("header", True)
        elif fmt == "parquet":
            rows = rows.option("mergeSchema", True)
        on = as_of or datetime.now(timezone.utc).date()
        dated = rows.load([f[0] for f in files]).withColumn("archived_on", F.lit(on.isoformat()))
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer = writer.partitionBy("archived_on", *kept)
        (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(
            f"{root}/expiry_id={expiry}"
        )
        storage.write_text(spark, f"{root}/{NOTES}/{expiry}.json", names)
        _finish(spark, root, expiry)
    return old


#: Folder of an archive with a list of the files of each expiry; Spark does not read it as data.
NOTES = "_expiries"


def _finish(spark: SparkSession, archive: str, expiry: str) -> None:
    """Delete the noted files of an expiry from its source."""
    noted = json.loads(storage.read_text(spark, f"{archive}/{NOTES}/{expiry}.json"))
    storage.drop_files(spark, [tuple(f) for f in noted["files"]])
    storage.write_text(spark, f"{archive}/{NOTES}/{expiry}.done", "")


def _settle(spark: SparkSession, archive: str, prefix: str) -> None:
    """Settle the expiries of a source that broke off."""
    for folder in storage.subdirectories(spark, archive):
        name, _, expiry = folder.rsplit("/", 1)[-1].partition("=")
        if name == "archived_on":
            raise ValueError(f"{archive} has folders of an older layout; give another archive")
        if name != "expiry_id" or not expiry.startswith(f"x{prefix}-"):
            continue
        note = f"{archive}/{NOTES}/{expiry}"
        if not storage.exists(spark, f"{note}.json"):
            storage.drop_directory(spark, folder)
        elif not storage.exists(spark, f"{note}.done"):
            _finish(spark, archive, expiry)
