"""Streams must give what the batch form gives."""

import uuid

from alertlake.fixture import DEDUPE_ORDER
from alertlake.operators.dedupe import dedupe_alerts
from alertlake.operators.reassoc import detect_reassociations
from alertlake.streaming.ingest import run_bounded
from alertlake.streaming.reassoc import detect_in_stream

COLUMNS = ["alert_id", "dia_source_id", "mjd", "ss_object_id", "ss_object_reassoc_time_mjd"]
KEYS = ["alert_id", "dia_source_id", "reassociation_reason", "is_new_source"]


def test_state_is_carried_across_batches_and_runs(spark, tables, tmp_path):
    rows = dedupe_alerts(tables.fx.where("dia_source_id < 100"), DEDUPE_ORDER).select(*COLUMNS)
    rows.write.parquet(str(tmp_path / "all"))
    rows = spark.read.parquet(str(tmp_path / "all"))
    source, out = str(tmp_path / "in"), str(tmp_path / f"out-{uuid.uuid4().hex}")
    parts = ["mjd < 50500", "mjd >= 50500 AND mjd < 51000", "mjd >= 51000"]
    for part in parts:  # one run, hence at least one batch, per part, in order of arrival
        rows.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        query = (
            detect_in_stream(stream)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "offsets"))
            .trigger(availableNow=True)
            .start()
        )
        assert run_bounded(query, 120)
    got = spark.read.parquet(out).select(*KEYS)
    want = detect_reassociations(rows).select(*KEYS)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
