"""What an ingest run passes through shuffles, and that it stores the same for it."""

from pyspark.sql import functions as F

from alertlake.operators import dedupe, skew, state
from alertlake.plans import ingest, storage
from alertlake.plans.storage import Lake
from alertlake.schema import ALERT_COLUMNS
from alertlake.sources.packets import complete


def make(spark, rows):
    """Alerts of (alert_id, source, mjd, snr, ss_object_id)."""
    names = ("alert_id", "dia_source_id", "mjd", "snr", "ss_object_id")
    kinds = "alert_id long, dia_source_id long, mjd double, snr double, ss_object_id string"
    frame = spark.createDataFrame(rows, kinds)
    given = {c: F.col(c) for c in names} | {"ra": F.lit(10.0), "dec": F.lit(1.0)}
    return frame.select(*[complete(given, c).alias(c) for c in ALERT_COLUMNS])


def exchanged(frame):
    """Lines of the plan that say what an exchange takes, but for that by day."""
    execution = frame._jdf.queryExecution()
    text = frame.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(execution, "formatted")
    parts = [p for p in text.split("\n\n") if ") Exchange" in p.split("\n")[0]]
    return [p for p in parts if "REBALANCE" not in p]


def test_whole_alerts_are_not_shuffled_before_their_day(spark, tmp_path, monkeypatch):
    lake, seen, write = Lake(str(tmp_path / "lake")), [], storage.write_by_day

    def watched(alerts, *args, **options):
        seen.append(exchanged(alerts))
        write(alerts, *args, **options)

    monkeypatch.setattr(storage, "write_by_day", watched)
    rows = [(i, i % 7, 60000.0 + i, 5.0, "S" if i > 20 else None) for i in range(40)]
    for k, upto in enumerate((30, 40)):
        ingest.ingest(make(spark, rows[:upto]), lake, run_id=f"r{k}", broadcast_rows=0)
    assert len(seen) == 2 and all(seen)
    assert not [x for plan in seen for x in plan if "snr" in x]
    assert lake.read(spark, "alerts").count() == 40


def test_copies_are_told_apart_on_few_columns(spark, tmp_path, monkeypatch):
    """Whole alerts are read once, and the copy that stays is the one that whole rows would give."""
    seen, write = [], storage.write_by_day

    def watched(alerts, *args, **options):
        explained = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
        seen.append(explained(alerts._jdf.queryExecution(), "formatted"))
        write(alerts, *args, **options)

    monkeypatch.setattr(storage, "write_by_day", watched)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    # Copies of one time that differ in their flux, twins, and a row that is refused.
    rows = [(i, i % 7, 60000.0 + i, 5.0 + k, "S" if k else None) for i in range(1, 30) for k in (0, 1, 2, 2)]
    alerts = make(spark, [*rows, (99, None, 60000.0, 5.0, None)]).withColumn("ingested_at", F.lit("2026-01-01").cast("timestamp"))
    want = sorted((r.alert_id, r.snr) for r in dedupe.dedupe_alerts(ingest.prepare(alerts.where("alert_id < 99"))).collect())
    for k, (track, at) in enumerate(((True, 0), (True, 10**6), (False, 0))):
        lake = Lake(str(tmp_path / f"lake{k}"))
        run = ingest.ingest(alerts, lake, run_id="a", track_state=track, broadcast_rows=at)
        assert (run.alerts_received, run.alerts_failed, run.alerts_ingested) == (117, 1, 29)
        assert sorted((r.alert_id, r.snr) for r in lake.read(spark, "alerts").collect()) == want
        refused = spark.read.parquet(lake.path("quarantine"))
        assert refused.count() == 1 and not {ingest.STAGED, ingest.TIE} & set(refused.columns)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert [sum("snr" in x for x in plan.split("\n") if x.startswith("ReadSchema")) for plan in seen] == [1, 1, 1]


def test_one_alert_id_of_two_sources(spark, tmp_path):
    rows = [(1, 1, 60000.0, 5.0, None), (1, 2, 60001.0, 6.0, "S"), (2, 1, 60002.0, 7.0, "S"), (2, 1, 60002.0, 7.0, "S")]
    later = [(1, 3, 60003.0, 8.0, None), (3, 1, 60004.0, 9.0, "T")]
    for k, (skip, stored) in enumerate(((True, 4), (False, 5))):
        for j, at in enumerate((0, 10**6)):
            lake = Lake(str(tmp_path / f"lake{k}{j}"))
            first = ingest.ingest(make(spark, rows), lake, run_id="a", skip_duplicates=skip, broadcast_rows=at)
            assert (first.alerts_received, first.alerts_ingested, first.new_sources) == (4, 3, 2)
            ingest.ingest(make(spark, later), lake, run_id="b", skip_duplicates=skip, broadcast_rows=at)
            found = lake.read(spark, "alerts")
            reasons = {(r.alert_id, r.dia_source_id): r.reassociation_reason for r in found.collect()}
            assert found.count() == len(reasons) == stored
            assert reasons[2, 1] == "new_association" and reasons[1, 2] is None
            assert reasons[3, 1] == "changed_association"  # against the stored state


def test_hot_key_is_found_by_parts(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert not skew.has_hot_key(rows, "k", 10) and skew.has_hot_key(rows, "k", 9)
    part = F.col("k") % 4
    assert not skew.has_hot_key(rows, "k", 10, (part, {0: 10})) and skew.has_hot_key(rows, "k", 9, (part, {0: 250}))
    none = spark.createDataFrame([(None,)] * 5 + [(1,)], "k long")
    assert skew.has_hot_key(none, "k", 4) and not skew.has_hot_key(none, "k", 5)


def test_latest_row_gives_the_state(spark):
    rows = [(1, 7, 60000.0, 1.0, "S"), (2, 7, 60001.0, 1.0, None), (3, 7, 60001.0, 1.0, "T"), (4, 8, 60000.0, 1.0, None)]
    alerts = make(spark, rows)
    found = {r.dia_source_id: r for r in state.source_state(alerts).collect()}
    assert (found[7].last_alert_id, found[7].ss_object_id, found[7].observation_count) == (3, "T", 3)
    assert (found[7].first_seen_mjd, found[7].last_seen_mjd) == (60000.0, 60001.0)
    halves = [state.source_state(alerts.where(x)) for x in ("alert_id < 3", "alert_id >= 3")]
    assert sorted(state.merge_states(halves[0].unionByName(halves[1])).collect()) == sorted(found.values())
    carried = state.source_state(alerts.where("alert_id < 3"), carry_forward=True).first()
    assert (carried.last_alert_id, carried.ss_object_id) == (2, "S")
