"""Streaming forms: micro-batched ingest, stream dedupe, bounded runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alertlake.plans.ingest import ingest
from alertlake.plans.storage import Lake, drop_directory
from alertlake.schema import ALERT_KEY
from alertlake.session import scratch_path
from alertlake.sources.wire import decoded_rows, split_decoded


def start_ingest(
    stream: DataFrame,
    lake: Lake,
    checkpoint: str,
    *,
    name: str = "stream",
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Each micro-batch is one ingest run named after its batch id. A batch that is replayed
    after a failure overwrites its own folders, so every alert is stored once. Offsets are
    in the checkpoint. Without ``every`` the query stops when the input is used up. A batch is
    bounded at the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``): rows left out
    here would be lost, as the checkpoint goes past the whole batch."""
    _refuse_limit(options)

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest(batch, lake, run_id=f"{name}-{batch_id}", source_name=name, **options)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_message_ingest(
    messages: DataFrame,
    lake: Lake,
    checkpoint: str,
    *,
    name: str = "messages",
    every: str | None = None,
    decode: dict | None = None,
    **options,
) -> StreamingQuery:
    """Framed messages: those that do not decode are kept under ``undecoded``."""
    _refuse_limit(options)

    def write(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{name}-{batch_id}"
        # Decoded once: both parts and the counts come from the stored rows.
        spark, given = batch.sparkSession, decode or {}
        staging = scratch_path(spark, f"decoded-{run_id}")
        rows = decoded_rows(batch, **given)
        rows.write.parquet(staging)
        stored = spark.read.schema(rows.schema).parquet(staging)
        good, bad = split_decoded(stored, given.get("value", "value"))
        bad.write.mode("overwrite").parquet(lake.run_path("undecoded", run_id))
        ingest(good, lake, run_id=run_id, source_name=name, undecoded=bad.count(), **options)
        drop_directory(spark, staging)

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _refuse_limit(options: dict) -> None:
    if options.get("max_alerts"):
        raise ValueError("max_alerts would lose the rest of a micro-batch: bound the source instead")


def run_bounded(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Wait until the query is done, or stop it after ``seconds``. True if it finished."""
    if seconds is None:
        query.awaitTermination()
        return True
    done = query.awaitTermination(seconds)
    if not done:
        query.stop()
    return bool(done)


def dedupe_stream(stream: DataFrame, within: str = "2 days") -> DataFrame:
    """Drop repeats of (alert_id, dia_source_id) that arrive within ``within`` of each other.

    The watermark is on the time of arrival, which bounds the state and makes no row late: an
    alert observed long ago is kept if it is new. Repeats from further back are caught
    against the stored table.
    """
    arrived = fresh_name(stream.columns, "arrived_at")
    timed = stream.withColumn(arrived, F.current_timestamp())
    unique = timed.withWatermark(arrived, within).dropDuplicatesWithinWatermark(list(ALERT_KEY))
    return unique.drop(arrived)


def fresh_name(taken: list[str], name: str) -> str:
    while name in taken:
        name = f"_{name}"
    return name
