"""Ingest, processors and files on small inputs."""

from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from alertlake.plans import export, ingest, processors
from alertlake.plans.storage import Lake
from alertlake.schema import ALERT_COLUMNS
from alertlake.sources import files, registry
from alertlake.sources.packets import complete


def make_alerts(spark, ids, **changed):
    given = {
        "alert_id": F.col("id"),
        "dia_source_id": F.col("id") % 5,
        "ra": F.lit(10.0),
        "dec": F.lit(1.0),
        "mjd": F.lit(60000.0) + F.col("id") / 10,
        "ss_object_id": F.when(F.col("id") >= 10, F.lit("S")),
        **changed,
    }
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    return frame.select(*[complete(given, c).alias(c) for c in ALERT_COLUMNS])


def test_ingest_again_stores_nothing(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    alerts = make_alerts(spark, list(range(20)) + [3, 4])
    first = ingest.ingest(alerts, lake, run_id="a")
    assert (first.alerts_received, first.alerts_ingested, first.new_sources) == (22, 20, 5)
    assert first.updated_sources == 15 and first.reassociations_detected == 5
    second = ingest.ingest(alerts, lake, run_id="b")
    assert (second.alerts_ingested, second.status) == (0, "completed")
    events = [r.status for r in lake.read(spark, "runs").where("run_id = 'b'").orderBy("event_at").collect()]
    assert events == ["running", "completed"]
    # replay of a run id gives the same table
    ingest.ingest(alerts, lake, run_id="a")
    assert lake.read(spark, "alerts").count() == 20
    assert ingest.current_state(spark, lake).agg(F.sum("observation_count")).first()[0] == 20
    before = sorted(ingest.current_state(spark, lake).drop("run_id").collect())
    ingest.rebuild_state(spark, lake)
    assert sorted(ingest.current_state(spark, lake).collect()) == before


def test_rejected_rows_are_kept_apart(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    alerts = make_alerts(spark, range(6), ra=F.when(F.col("id") < 2, 400.0).otherwise(1.0))
    stats = ingest.ingest(alerts, lake, run_id="a")
    assert (stats.alerts_failed, stats.alerts_ingested) == (2, 4)
    kept = spark.read.parquet(lake.run_path("quarantine", "a"))
    assert {tuple(r["failed_rules"]) for r in kept.collect()} == {("ra_range",)}


def test_failed_run_is_logged(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    broken = make_alerts(spark, [1], mjd=F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception):
        ingest.ingest(broken, lake, run_id="a")
    assert ingest.latest_runs(spark, lake).first()["status"] == "failed"


def test_runner_captures_errors(spark, tmp_path):
    class Broken(processors.Processor):
        name = "broken"

        def transform(self, alerts):
            raise RuntimeError("no")

    processors.register(Broken)
    try:
        runner = processors.Runner(make_alerts(spark, range(20)), Lake(str(tmp_path)))
        as_of = datetime(2023, 2, 27)
        broken, example = runner.run_all(["broken", "example"], as_of=as_of)
        assert broken.status == "failed" and broken.row["error_message"] == "no"
        assert example.status == "completed" and example.row["record_count"] == 1
        assert example.row["input_rows"] == 20
        assert len(runner.run_all(["broken", "example"], as_of=as_of, stop_on_error=True)) == 1
        empty = runner.run("example", as_of=datetime(1990, 1, 1))
        assert empty.status == "skipped"
        assert runner.run("absent").status == "failed"
    finally:
        assert processors.unregister("broken")


def test_states_of_a_hot_key_are_merged(spark):
    """A Python group function with a key that holds most rows: few states are left to combine."""

    class Span(processors.GroupProcessor):
        name, group_by = "span", "dia_source_id"
        partial_schema = "dia_source_id long, n long, low double, high double"
        result_schema = "dia_source_id long, n long, span double, states long"

        @staticmethod
        def partial(key, group):
            return pd.DataFrame([(key, len(group), group["mjd"].min(), group["mjd"].max())], columns=STATE)

        @staticmethod
        def merge(key, parts):
            return pd.DataFrame([(key, parts["n"].sum(), parts["low"].min(), parts["high"].max())], columns=STATE)

        @staticmethod
        def combine(key, parts):
            span = parts["high"].max() - parts["low"].min()
            return {"dia_source_id": key, "n": int(parts["n"].sum()), "span": float(span), "states": len(parts)}

    STATE = ["dia_source_id", "n", "low", "high"]
    key = F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id") % 40 + 100)
    rows = spark.range(0, 40_000, 1, 4).select(key.alias("dia_source_id"), (F.col("id") / 8).alias("mjd"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {r.dia_source_id: r for r in Span().run(rows, 0.0, 1e6).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert (got[1].n, got[1].span) == (30_000, (39_999 - 1) / 8)
    assert got[1].states <= 4  # one for each part of the key, not one for each batch
    assert sum(r.n for r in got.values()) == 40_000 and len(got) == 11

    class Half(processors.GroupProcessor):
        name, group_by = "half", "dia_source_id"
        partial = Span.partial

    with pytest.raises(NotImplementedError):
        Half().run(rows, 0.0, 1e6)


def test_dated_csv_range(spark, tmp_path):
    for day in ("20240101", "20240102", "20240103"):
        (tmp_path / f"alerts_{day}.csv").write_text(f"alertId,day\n1,{day}\n")
    out = files.read_dated_csv(spark, str(tmp_path), date(2024, 1, 2), date(2024, 1, 3))
    assert sorted(r["day"] for r in out.collect()) == ["20240102", "20240103"]


def test_file_tree_and_registry(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    head = "alertId,diaSourceId,ra,decl,midPointTai,hasSSSource,snr\n"
    (tmp_path / "a.csv").write_text(head + "1,2,3.0,4.0,5.0,True,\n2,2,,4.0,5.0,False,1\n")
    (tmp_path / "sub" / "b.csv").write_text(head + "3,2.0,3.0,4.0,5.0,0,x\n4,2,3.0,4.0,5.0,1,2\n")
    out = registry.read(spark, "files", str(tmp_path)).orderBy("alert_id").collect()
    assert [(r["alert_id"], r["has_ss_source"]) for r in out] == [(1, True), (4, True)]
    assert registry.read(spark, "files", str(tmp_path), limit=1).count() == 1
    with pytest.raises(ValueError):
        registry.get("absent")


def test_merge_keeps_first(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n10,a\n9,b\n")
    (tmp_path / "b.csv").write_text("k,w\n10,c\n1,d\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "none.csv")]
    out = str(tmp_path / "out")
    assert export.merge_csv(spark, paths, out, dedupe_column="k", sort_by="k") == 3
    rows = spark.read.option("header", True).csv(out).collect()
    assert {(r["k"], r["v"], r["w"]) for r in rows} == {("10", "a", None), ("9", "b", None), ("1", None, "d")}
