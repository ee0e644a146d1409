"""Framed messages (magic byte, schema id, payload) and streams of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.schema import ALERT_COLUMNS, PACKET_SCHEMA
from alertlake.sources.packets import flat_columns, with_verdict

HEADER_BYTES = 5  # fixed value: magic byte 0 and a 4-byte big-endian schema id
_CORRUPT = "_corrupt"


class MissingPackage(RuntimeError):
    """A connector jar is not on the class path."""


def require_format(spark: SparkSession, class_name: str, package: str) -> None:
    try:
        spark._jvm.java.lang.Class.forName(
            class_name, True, spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        )
    except Exception as err:
        raise MissingPackage(
            f"start Spark with --packages {package}:{spark.version}"
        ) from err


def require_avro(spark: SparkSession) -> None:
    require_format(
        spark, "org.apache.spark.sql.v2.avro.AvroDataSourceV2", "org.apache.spark:spark-avro_2.13"
    )


def require_kafka(spark: SparkSession) -> None:
    require_format(
        spark,
        "org.apache.spark.sql.kafka010.KafkaSourceProvider",
        "org.apache.spark:spark-sql-kafka-0-10_2.13",
    )


def split_header(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add schema_id (null without a header) and payload (header removed)."""
    raw = F.col(value)
    framed = (F.octet_length(raw) > HEADER_BYTES) & (F.hex(F.substring(raw, 1, 1)) == "00")
    number = F.conv(F.hex(F.substring(raw, 2, 4)), 16, 10).cast("long")
    body = F.substring(raw, F.lit(HEADER_BYTES + 1), F.octet_length(raw))
    return messages.withColumn("schema_id", F.when(framed, number)).withColumn(
        "payload", F.when(framed, body).otherwise(raw)
    )


def _json(payload: Column, schema: T.StructType) -> Column:
    with_error = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_json(payload.cast("string"), with_error, options)


def _avro(spark: SparkSession, payload: Column, schema: str) -> tuple[Column, T.StructType]:
    from pyspark.sql.avro.functions import from_avro

    require_avro(spark)
    packet = from_avro(payload, schema, {"mode": "PERMISSIVE"})
    no_rows = spark.range(0).select(F.lit(b"").alias("payload"))
    shape = no_rows.select(from_avro("payload", schema).alias("p")).schema["p"].dataType
    return packet, shape


DECODED, MESSAGE = "_decoded", "_message"


def decode_messages(
    messages: DataFrame,
    default: T.StructType | str = PACKET_SCHEMA,
    by_schema_id: dict[int, T.StructType | str] | None = None,
    *,
    value: str = "value",
    encoding: str = "json",
) -> tuple[DataFrame, DataFrame]:
    """(flat alerts, messages that failed to decode); see ``decoded_rows`` for one pass over both."""
    return split_decoded(
        decoded_rows(messages, default, by_schema_id, value=value, encoding=encoding), value
    )


def split_decoded(rows: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """The two parts of ``decoded_rows``, for instance of its stored rows."""
    bad = rows.where(~F.col(DECODED)).select(F.col(MESSAGE).alias(value), "schema_id")
    return rows.where(DECODED).select(*ALERT_COLUMNS), bad


def decoded_rows(
    messages: DataFrame,
    default: T.StructType | str = PACKET_SCHEMA,
    by_schema_id: dict[int, T.StructType | str] | None = None,
    *,
    value: str = "value",
    encoding: str = "json",
) -> DataFrame:
    """A row for each message: flat alert, schema id, whether it was decoded, and the message
    itself where it was not; all schemas in a single pass.

    ``encoding`` json takes StructTypes, avro takes Avro schema texts. Each message uses
    the schema of its header id, or the default one.
    """
    split = split_header(messages, value)
    known = by_schema_id or {}
    shapes: dict[str, T.StructType] = {}
    parsed: dict[str, Column] = {}

    # Each message is parsed once, by its own schema, into a column of its own; the flat
    # columns then only pick members.
    def parse(name: str, schema, applies: Column) -> None:
        payload = F.when(applies, F.col("payload"))
        if encoding == "avro":
            parsed[name], shapes[name] = _avro(messages.sparkSession, payload, schema)
        else:
            parsed[name], shapes[name] = _json(payload, schema), schema

    sid = F.col("schema_id")
    other = ~F.coalesce(sid.isin(list(known)), F.lit(False)) if known else F.lit(True)
    parse("_default", default, other)
    for number, schema in known.items():
        parse(f"_schema_{number}", schema, sid == number)
    split = split.withColumns(parsed)

    def decoded(name: str) -> Column:
        packet = F.col(name)
        if encoding == "json":
            return packet.isNotNull() & packet[_CORRUPT].isNull()
        return packet["alertId"].isNotNull()

    # At most one of the parsed columns is set, so the flat columns are picked one by one.
    flat = [flat_columns(shapes[name], F.col(name)) for name in shapes]
    any_ok = F.lit(False)
    for name in shapes:
        any_ok = any_ok | decoded(name)
    split = with_verdict(split, DECODED, any_ok)
    picked = []
    for position, column in enumerate(ALERT_COLUMNS):
        choice = F.lit(None)
        for name, columns in zip(shapes, flat):
            choice = F.when(F.col(name).isNotNull(), columns[position]).otherwise(choice)
        picked.append(choice.alias(column))
    return split.select(
        *picked, "schema_id", DECODED, F.when(~F.col(DECODED), F.col(value)).alias(MESSAGE)
    )


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    max_per_trigger: int | None = None,
    starting: str = "earliest",
    **options: str,
) -> DataFrame:
    """Streaming frame of raw messages; offsets are kept by the query's checkpoint."""
    require_kafka(spark)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.options(**options).load()
