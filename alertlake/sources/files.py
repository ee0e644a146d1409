"""Alert files: CSV, nested JSON lines, Avro, Parquet; dated daily files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.functions import exprs as X
from alertlake.operators.sets import concat_differing
from alertlake.schema import ALERT_COLUMNS, ALERT_SCHEMA, PACKET_SCHEMA
from alertlake.sources.packets import complete, flatten_packet, prefix_map, with_verdict
from alertlake.sources.wire import require_avro

# CSV header name -> flat column.
CSV_NAMES = {
    "alertId": "alert_id",
    "diaSourceId": "dia_source_id",
    "diaObjectId": "dia_object_id",
    "decl": "dec",
    "midPointTai": "mjd",
    "filterName": "filter_name",
    "psFlux": "ps_flux",
    "psFluxErr": "ps_flux_err",
    "extendednessMedian": "extendedness_median",
    "extendednessMin": "extendedness_min",
    "extendednessMax": "extendedness_max",
    "hasSSSource": "has_ss_source",
    "ssObjectId": "ss_object_id",
    "ssObjectReassocTimeMjdTai": "ss_object_reassoc_time_mjd",
    "isReassociation": "is_reassociation",
    "reassociationReason": "reassociation_reason",
}
REQUIRED = ("alert_id", "dia_source_id", "ra", "dec", "mjd")
_DATE_IN_NAME = r"_(\d{8})\.csv"
_MALFORMED, _TYPED = "_malformed", "_typed_"


def _typed(text: Column, dtype: T.DataType) -> Column:
    """Cast that yields null where the text does not fit; ids may be written as 12.0."""
    if isinstance(dtype, T.LongType):
        as_number = text.try_cast("double")
        whole = F.when(as_number == F.floor(as_number), as_number.try_cast("long"))
        return F.coalesce(text.try_cast("long"), whole)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0)
    return text.try_cast(dtype)


def _with_json(text: Column, from_columns: Column, kind: T.MapType) -> Column:
    """A map written as JSON text, with the entries that have columns of their own; those win."""
    written = F.coalesce(F.from_json(text, kind), F.create_map().cast(kind))
    others = F.map_filter(written, lambda k, v: v.isNotNull() & ~F.map_contains_key(from_columns, k))
    return F.map_concat(others, from_columns)


def csv_to_alerts(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns under either naming style -> flat alerts plus ``_malformed`` and ``keep``.

    A row is malformed if a required value is missing or any value does not fit its type.
    """
    # Trimmed texts, then typed values, then what is made of both: each is made once, and the code that
    # Spark generates for one projection stays small enough to be compiled.
    named = rows.withColumnsRenamed(CSV_NAMES)
    plain = [
        f for f in ALERT_SCHEMA.fields if f.name in named.columns and not isinstance(f.dataType, T.MapType)
    ]
    trimmed = named.withColumns({f.name: F.trim(f.name) for f in plain})
    texts = trimmed.withColumns(
        {f.name: F.when(~F.lower(f.name).isin("", "nan"), F.col(f.name)) for f in plain}
    )
    typed = [f for f in plain if not isinstance(f.dataType, T.StringType)]
    named = texts.withColumns({f"{_TYPED}{f.name}": _typed(F.col(f.name), f.dataType) for f in typed})
    given: dict[str, Column] = {}
    broken = F.lit(False)
    for field in plain:
        text = F.col(field.name)
        if field not in typed:
            given[field.name] = F.lower(text) if field.name == "filter_name" else text
        else:
            given[field.name] = F.col(f"{_TYPED}{field.name}")
            broken = broken | (text.isNotNull() & given[field.name].isNull())
    for name in REQUIRED:
        if name not in given:
            given[name] = X.typed_null(ALERT_SCHEMA[name].dataType)
        broken = broken | given[name].isNull()

    others = [c for c in rows.withColumnsRenamed(CSV_NAMES).columns if c not in ALERT_COLUMNS and c not in keep]
    maps = {
        "trail_data": prefix_map(
            lambda n: F.col(n).try_cast("double"), others, "trail", T.DoubleType()
        ),
        "pixel_flags": prefix_map(
            lambda n: _typed(F.trim(F.col(n)), T.BooleanType()), others, "pixelFlags", T.BooleanType()
        ),
    }
    for name, from_columns in maps.items():
        given[name] = from_columns
        if name in named.columns:
            given[name] = _with_json(F.col(name), from_columns, ALERT_SCHEMA[name].dataType)
    for flag in ("has_ss_source", "is_reassociation"):
        if flag in given:
            given[flag] = F.coalesce(given[flag], F.lit(False))
    if "ingested_at" in given:
        given["ingested_at"] = F.coalesce(given["ingested_at"], F.current_timestamp())
    columns = [complete(given, name).alias(name) for name in ALERT_COLUMNS]
    judged = with_verdict(named, _MALFORMED, F.coalesce(broken, F.lit(False)))
    return judged.select(*columns, *keep, _MALFORMED)


def _csv_reader(spark: SparkSession, sep: str, recursive: bool, pattern: str | None):
    # No schema inference (a second pass over the data): the header names the columns, all
    # are text. A file with another header is an error rather than shifted columns.
    # Quotes inside values are doubled, as CSV writers do.
    reader = spark.read.options(header=True, sep=sep, enforceSchema=False, escape='"')
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def csv_by_header(
    spark: SparkSession,
    paths: str | list[str],
    *,
    sep: str = ",",
    recursive: bool = False,
    pattern: str | None = None,
) -> list[DataFrame]:
    """The files of ``paths`` as text columns, a DataFrame for each distinct header line.

    The headers take a pass over the lines of the files' first blocks; what comes to the driver
    is a row for each header with the paths of its files, which Spark lists there in any case.
    """
    reader = spark.read.options(recursiveFileLookup=recursive)
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    lines = reader.text(paths).where("_metadata.file_block_start = 0").select(
        "value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at")
    )
    heads = lines.groupBy("path").agg(F.min_by("value", "at").alias("head"))
    groups = heads.groupBy("head").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    # Order of the smallest path: columns come out in the same order every time.
    found = sorted((r["paths"], r["head"]) for r in groups.collect())
    return [_csv_reader(spark, sep, False, None).csv([unquote(p) for p in group]) for group, _ in found]


def read_csv_text(
    spark: SparkSession,
    paths: str | list[str],
    *,
    sep: str = ",",
    recursive: bool = False,
    pattern: str | None = None,
    mixed_headers: bool = False,
) -> DataFrame:
    """All columns as text. ``mixed_headers``: the given paths differ in their columns."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    reader = _csv_reader(spark, sep, recursive, pattern)
    if mixed_headers and len(listed) > 1:
        return concat_differing([reader.csv(p) for p in listed])
    return reader.csv(listed)


def read_csv_alerts(
    spark: SparkSession, paths: str | list[str], **options
) -> DataFrame:
    """Flat alerts of CSV files; malformed rows are left out (see ``csv_to_alerts``)."""
    flat = csv_to_alerts(read_csv_text(spark, paths, **options))
    return flat.where(~F.col(_MALFORMED)).drop(_MALFORMED)


def read_avro_alerts(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    require_avro(spark)
    reader = spark.read.format("avro").option("ignoreCorruptFiles", True).options(**options)
    return flatten_packet(reader.load(paths))


def read_json_alerts(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType = PACKET_SCHEMA,
    **options,
) -> DataFrame:
    """Nested packets as JSON lines; lines that do not parse are left out."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED").options(**options)
    return flatten_packet(reader.json(paths))


#: Rows that a reader could not take.
REJECT_COLUMNS = ("path", "reason", "record")


def read_json_with_rejects(
    spark: SparkSession, paths: str | list[str], schema: T.StructType = PACKET_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """(flat alerts, rejects) of JSON lines: a reject holds the file, the reason and the line itself.

    Each line is in one of the two; blank lines are in neither. A packet without its alert id or
    source is rejected, since no run could store it.
    """
    whole = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    parsed = lines.where(F.trim("value") != "").withColumn("packet", F.from_json("value", whole, options))
    reason = (
        F.when(F.col("packet").isNull() | F.col("packet._broken").isNotNull(), "no JSON packet")
        .when(F.col("packet.alertId").isNull(), "no alert id")
        .when(F.col("packet.diaSource.diaSourceId").isNull(), "no source id")
    )
    judged = with_verdict(parsed, "reason", reason)
    good = judged.where("reason IS NULL").select(*(F.col(f"packet.{f.name}").alias(f.name) for f in schema.fields))
    bad = judged.where("reason IS NOT NULL").select("path", "reason", F.col("value").alias("record"))
    return flatten_packet(good), bad


def read_parquet_alerts(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Nested packets stored as Parquet; if already flat, the rows as they are."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    rows = spark.read.options(**options).parquet(*listed)
    return rows if "alert_id" in rows.columns else flatten_packet(rows)


READERS = {
    "csv": read_csv_alerts,
    "avro": read_avro_alerts,
    "json": read_json_alerts,
    "parquet": read_parquet_alerts,
}
_EXTENSIONS = {"csv": "*.csv", "tsv": "*.tsv", "avro": "*.avro", "json": "*.{json,jsonl,json.gz,jsonl.gz}"}


def _has_files(spark: SparkSession, path: str, pattern: str) -> bool:
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path")
    )
    return not found.limit(1).isEmpty()


def _kind_of(path: str) -> str | None:
    for kind, pattern in _EXTENSIONS.items():
        if any(path.endswith("." + e) for e in pattern[2:].strip("{}").split(",")):
            return kind
    return "parquet" if path.endswith(".parquet") else None


def read_alert_files(
    spark: SparkSession, path: str, file_type: str | None = None, *, limit: int | None = None
) -> DataFrame:
    """A file, a glob, or a directory tree of alert files of any of the formats.

    The limit is over all files together.
    """
    kind = file_type or _kind_of(path)
    if kind == "tsv":
        out = read_csv_alerts(spark, path, sep="\t")
    elif kind:
        out = READERS[kind](spark, path)
    else:
        out = None
        for kind, pattern in _EXTENSIONS.items():
            if not _has_files(spark, path, pattern):
                continue
            if kind in ("csv", "tsv"):
                sep = "\t" if kind == "tsv" else ","
                trees = csv_by_header(spark, path, sep=sep, recursive=True, pattern=pattern)
                flat = reduce(DataFrame.unionByName, map(csv_to_alerts, trees))
                part = flat.where(~F.col(_MALFORMED)).drop(_MALFORMED)
            else:
                part = READERS[kind](
                    spark, path, recursiveFileLookup=True, pathGlobFilter=pattern
                )
            out = part if out is None else out.unionByName(part)
        if out is None:
            raise FileNotFoundError(f"no alert files below {path}")
    return out.limit(limit) if limit else out


def read_dated_csv(
    spark: SparkSession,
    path: str,
    start: date | None = None,
    end: date | None = None,
    *,
    pattern: str = "*.csv",
) -> DataFrame:
    """Daily files ``<prefix>_YYYYMMDD.csv`` below ``path``; inclusive date range.

    The date comes from the file name, so files outside the range are skipped when the
    input is listed. Adds ``file_date``. Files may differ in their columns.
    """
    return concat_differing(_dated(spark, path, start, end, pattern))


def read_dated_alerts(
    spark: SparkSession,
    path: str,
    start: date | None = None,
    end: date | None = None,
    *,
    pattern: str = "*.csv",
) -> DataFrame:
    """``read_dated_csv`` as flat alerts with ``file_date``; malformed rows are left out."""
    parts = [csv_to_alerts(p, ["file_date"]) for p in _dated(spark, path, start, end, pattern)]
    return reduce(DataFrame.unionByName, parts).where(~F.col(_MALFORMED)).drop(_MALFORMED)


def _dated(
    spark: SparkSession, path: str, start: date | None, end: date | None, pattern: str
) -> list[DataFrame]:
    stamp = F.regexp_extract(F.col("_metadata.file_name"), _DATE_IN_NAME, 1)
    day = F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd")).cast("date")
    parts = []
    for text in csv_by_header(spark, path, recursive=True, pattern=pattern):
        if start is not None:
            text = text.where(day >= F.lit(start))
        if end is not None:
            text = text.where(day <= F.lit(end))
        parts.append(text.withColumn("file_date", day))
    return parts
