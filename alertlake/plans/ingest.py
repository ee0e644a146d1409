"""Ingestion: validate -> dedupe -> drop stored -> flag reassociations -> append -> state.

A run writes only below ``run_id=<id>`` folders, with overwrite, and never reads its own:
replaying a run id after a failure gives the same tables again. What earlier runs have stored is
looked up in the key store (``plans/store.py``), in the buckets of the batch's own ids.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from alertlake.operators import dedupe, reassoc, sets, skew, validate
from alertlake.plans import compaction, storage
from alertlake.plans.storage import TABLES, Lake
from alertlake.plans.store import HASHES, Store, hash_of
from alertlake.schema import ALERT_COLUMNS, ALERT_KEY, RUN_EVENT_SCHEMA
from alertlake.session import scratch_path
from alertlake.sources import files

# Batches up to this many rows have their keys broadcast (two numbers each: ~16 MB).
SMALL_BATCH_ROWS = 1_000_000
#: What the rows of a source are compared by.
COMPARED = (*ALERT_KEY, "mjd", "ss_object_id", "ss_object_reassoc_time_mjd")
#: Columns of staged rows: a number for each row, and the hash that orders copies of one time.
STAGED, TIE = "_staged_row", "_tie"
#: Counts of a run, from the tables that it has written.
COUNTS = (
    "alerts_received",
    "alerts_ingested",
    "alerts_failed",
    "new_sources",
    "updated_sources",
    "reassociations_detected",
    "cutouts_saved",
)


def current_state(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per source, as the runs have left it."""
    return (Store.read(spark, lake) or Store(spark, lake)).states()


def rebuild_state(spark: SparkSession, lake: Lake) -> None:
    """Write keys and states anew from the alert table."""
    Store.rebuild(spark, lake)


def compact(spark: SparkSession, lake: Lake) -> int:
    """Compact the alerts of finished runs; how many runs these were."""
    store = Store.read(spark, lake)
    return compaction.compact(spark, lake, store.manifest.pending if store else ())


def prepare(alerts: DataFrame) -> DataFrame:
    """Flat alerts in the fixed column order, normalised."""
    return validate.normalize_alerts(alerts.select(*ALERT_COLUMNS))


def dry_run(
    alerts: DataFrame, lake: Lake, *, skip_duplicates: bool = True
) -> DataFrame:
    """One row: what a run would store, without writing."""
    spark = alerts.sparkSession
    keys = ("alert_id",) if skip_duplicates else ALERT_KEY
    valid = prepare(alerts).where(validate.is_valid())
    store = Store.read(spark, lake)
    # A broken run may have stored alerts that no segment has yet.
    stored = lake.read(spark, "alerts") if store is None or store.manifest.pending else store.keys()
    fresh = sets.not_stored(dedupe.dedupe_alerts(valid), stored, keys=keys)
    return fresh.agg(F.count(F.lit(1)).alias("would_store"))


def ingest(
    alerts: DataFrame,
    lake: Lake,
    *,
    run_id: str | None = None,
    source_name: str = "batch",
    source_config: dict | None = None,
    skip_duplicates: bool = True,
    track_state: bool = True,
    max_alerts: int | None = None,
    undecoded: int = 0,
    broadcast_rows: int = SMALL_BATCH_ROWS,
) -> Row:
    """Run one batch and return its row of the run log. The run is logged as running when it
    begins; a failure is logged as a failed run and raised.

    ``max_alerts`` takes the first rows by key, so that a replay takes the same; the rest is
    left to the caller. Streams are bounded at their source instead. ``undecoded`` messages,
    which never became alerts, count as received and failed. Batches of more than
    ``broadcast_rows`` are shuffled against the store instead of broadcast.
    """
    spark = alerts.sparkSession
    now = datetime.now(timezone.utc)
    row = dict.fromkeys(RUN_EVENT_SCHEMA.fieldNames()) | {
        "run_id": run_id or uuid.uuid4().hex,
        "source_name": source_name,
        "source_config": json.dumps(source_config or {}, sort_keys=True),
        "started_at": now,
        "event_at": now,
        "status": "running",
    }
    lake.append_row(spark, "runs", row)
    clock, counts = time.monotonic(), Counter()
    try:
        bounded = alerts.orderBy(*ALERT_KEY, "mjd").limit(max_alerts) if max_alerts else alerts
        _run(spark, bounded, lake, row["run_id"], counts, skip_duplicates, track_state, broadcast_rows)
        counts.update(alerts_received=undecoded, alerts_failed=undecoded)
        row["status"] = "completed"
    except Exception as err:
        row |= {"status": "failed", "error_message": str(err)}
        raise
    finally:
        now = datetime.now(timezone.utc)
        taken = json.dumps({"elapsed_seconds": time.monotonic() - clock})
        row |= {c: counts[c] for c in COUNTS} | {"completed_at": now, "event_at": now, "metadata": taken}
        lake.append_row(spark, "runs", row)
    return Row(**row)


def _run(
    spark: SparkSession,
    alerts: DataFrame,
    lake: Lake,
    run_id: str,
    counts: Counter,
    skip_duplicates: bool,
    track_state: bool,
    broadcast_rows: int,
) -> None:
    """Stores the batch; ``counts`` is filled as the steps are done."""
    # 1. Checked rows go to a written table in the shared folder, without a shuffle. It cuts
    # the lineage, the steps below read single columns of it instead of parsing the input
    # again, and the counts come from it (metrics of running tasks repeat with the tasks).
    # Its files are cut into buckets of the key, so that neither duplicates nor stored keys
    # make whole alerts pass through a shuffle.
    keys = ("alert_id",) if skip_duplicates else ALERT_KEY
    staging = scratch_path(spark, f"staging-{run_id}")
    # Copies are told apart and compared on a few columns, and the hash of all others is made here, once.
    prepared = prepare(alerts)
    marks = {STAGED: F.monotonically_increasing_id(), TIE: dedupe.row_hash(prepared, (*ALERT_KEY, *dedupe.ARRIVAL))}
    checked = validate.annotate_violations(prepared).withColumns(marks)
    with storage.bucketed(checked, staging, keys) as staged:
        _store(spark, staged, lake, run_id, counts, keys, track_state, broadcast_rows)
    storage.drop_directory(spark, staging)


def _store(
    spark: SparkSession,
    staged: DataFrame,
    lake: Lake,
    run_id: str,
    counts: Counter,
    keys: tuple[str, ...],
    track_state: bool,
    broadcast_rows: int,
) -> None:
    """Stores the checked rows, which are in buckets of ``keys``."""
    accepted = F.size(validate.FAILED) == 0
    valid = staged.where(accepted).drop(validate.FAILED)
    parts = _count_parts(staged, accepted)
    received, failed = sum(parts.values()), parts.pop(None, 0)
    counts["alerts_received"], counts["alerts_failed"] = received, failed
    small = received <= broadcast_rows
    if failed:
        staged.where(~accepted).drop(STAGED, TIE).write.mode("overwrite").parquet(
            lake.run_path("quarantine", run_id)
        )

    # 2. Rows not stored by another run, flagged against the stored state of their source. Of
    # both, only the buckets that the batch falls in are read.
    store = Store.begin(spark, lake, run_id)
    compaction.forget_run(spark, lake, run_id)
    known = store.keys(_hashes(valid, received - failed))
    told_apart = valid.select(*COMPARED, *(c for c in dedupe.ARRIVAL if c not in COMPARED), STAGED, TIE)
    first = dedupe.dedupe_alerts(told_apart, (*dedupe.ARRIVAL, TIE))
    fresh = sets.not_stored(first, known, keys=keys, small_batch=small).select(*COMPARED, STAGED)
    if track_state:
        prior = store.states(list(parts))
        # Without a hot source, a batch is compared in one window over one pass.
        hot = not small and skew.has_hot_key(valid, "dia_source_id", counted=(hash_of("dia_source_id"), parts))
        flagged = _flag(valid, fresh, prior, small, hot, keys)
    else:
        flagged = _whole(valid, fresh.select(*keys, STAGED), keys).withColumn("is_new_source", F.lit(None).cast("boolean"))

    lake.note_day_width(spark)
    # 3. Append under the run; its state and counts are taken from what was written.
    target = lake.run_path("alerts", run_id)
    storage.write_by_day(
        flagged.select(*ALERT_COLUMNS, "is_new_source"),
        target,
        partition_days=lake.partition_days,
    )
    written = spark.read.schema(TABLES["alerts"]).parquet(target)
    stored = ("alerts_ingested", "reassociations_detected", "new_sources")
    found = written.agg(
        F.count(F.lit(1)), F.count_if("is_reassociation"), F.count_if("is_new_source")
    ).first()
    counts.update(dict(zip(stored, found, strict=True)))
    if track_state:
        counts["updated_sources"] = counts["alerts_ingested"] - counts["new_sources"]
    store.finish(run_id, track_state)


def _count_parts(staged: DataFrame, accepted: Column) -> Counter:
    """Accepted rows by hash of their source; those not accepted under None."""
    part = F.when(accepted, hash_of("dia_source_id")).alias("part")
    return Counter(dict(staged.groupBy(part).agg(F.count(F.lit(1))).collect()))


def _hashes(valid: DataFrame, rows: int) -> list[int] | None:
    """Hashes of the alert ids; None, which stands for all, for so many rows that hardly any is left out."""
    if rows > 100 * HASHES:
        return None
    return [r[0] for r in valid.select(hash_of("alert_id")).distinct().collect()]


def _whole(valid: DataFrame, chosen: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The staged rows that ``chosen`` has the keys and numbers of, with its other columns.

    Staged rows stay in their buckets of ``keys``: the join is by these alone, and the number is compared
    as a range, which is no join key."""
    names = {c: f"_chosen_{c}" for c in (*keys, STAGED)}
    number = F.col(names[STAGED])
    same = [*(F.col(c) == F.col(names[c]) for c in keys), F.col(STAGED).between(number, number)]
    return valid.join(chosen.withColumnsRenamed(names), reduce(and_, same)).drop(STAGED, TIE, *names.values())


def _flag(valid: DataFrame, fresh: DataFrame, prior: DataFrame, small: bool, hot: bool, keys: tuple[str, ...]) -> DataFrame:
    """Whole alerts with detected reassociations, together with those the source itself had flagged.

    Sources are compared on the columns that this takes; what was found goes back to the whole alerts,
    which stay in the buckets of ``keys``."""
    own = {"is_reassociation": "_own_flag", "reassociation_reason": "_own_reason"}
    found = reassoc.detect_reassociations(fresh, prior, probe=valid, small_batch=small, any_hot=hot)
    given = found.select(*keys, STAGED, *own, "is_new_source")
    return _whole(valid.withColumnsRenamed(own), given, keys).withColumns(
        {
            "is_reassociation": F.col("is_reassociation") | F.coalesce("_own_flag", F.lit(False)),
            "reassociation_reason": F.coalesce("reassociation_reason", "_own_reason"),
        }
    )


def ingest_json(spark: SparkSession, paths: str | list[str], lake: Lake, *, run_id: str, **options) -> Row:
    """Ingest JSON lines; lines that are no packets are kept under ``rejects`` and count as failed."""
    good, bad = files.read_json_with_rejects(spark, paths)
    target = lake.run_path("rejects", run_id)
    bad.write.mode("overwrite").parquet(target)
    kept = spark.read.schema(bad.schema).parquet(target)
    return ingest(good, lake, run_id=run_id, undecoded=storage.count_rows(kept), **options)


def latest_runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per run: its newest event."""
    return dedupe.latest_per_key(lake.read(spark, "runs"), ["run_id"], ["event_at"])
