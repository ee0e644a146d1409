"""Inputs of the registered queries, built from the tables."""

import os

from pyspark.sql import functions as F

from alertlake import queryset_io as QI
from alertlake import queryset_more as Q
from alertlake.fixture import Tables
from alertlake.queryset import QUERIES
from alertlake.session import scratch_path


def test_a_part_of_many_files_is_one_batch(spark, tables):
    path = scratch_path(spark, "many")
    for part in range(3):
        spark.range(part * 100, part * 100 + 100, numPartitions=5).write.mode("append").parquet(path)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", Q._per_trigger(tables, path, 3)).parquet(path)
    offsets = scratch_path(spark, "offsets")
    query = stream.writeStream.format("noop").option("checkpointLocation", offsets).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len([x for x in os.listdir(f"{offsets}/commits") if x.isdigit()]) == 3


def test_runs_over_one_input_derive_it_once(spark, tables, monkeypatch):
    """What the processors get has no window left in its plan: it is read from a stored table."""
    given = []

    class Runner(QI.PR.Runner):
        def __init__(self, alerts, lake):
            given.append(alerts)
            super().__init__(alerts, lake)

    monkeypatch.setattr(QI.PR, "Runner", Runner)
    QI._results_log(tables)
    plan = given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "MapInArrow" not in plan


def line_tables(spark):
    """Tables of a few lines of their own."""
    folder = scratch_path(spark, "lines")
    line = F.col("id") % 7 + 1
    spark.range(140).select(
        F.floor(F.col("id") / 7).alias("l_orderkey"),
        (F.col("id") % 11).alias("l_partkey"),
        (F.col("id") % 5).alias("l_suppkey"),
        line.cast("int").alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        (F.col("id") % 90 * 100.0 + 1000).alias("l_extendedprice"),
        F.lit(0.01).alias("l_discount"),
        (F.col("id") % 9 / 100).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "NRA")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.expr("timestamp'1995-01-02' + make_interval(0, 0, 0, int(id % 2400))").alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, folder)


def same_rows(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_exported_json_is_compressed(spark):
    t = line_tables(spark)
    found = QUERIES["export_json"].build(t)
    assert found.inputFiles() and all(f.endswith(".json.gz") for f in found.inputFiles())
    assert same_rows(found, QI._as_alerts(t.alerts).select(*found.columns))


def test_json_packets_are_read_compressed(spark):
    t = line_tables(spark)
    found = QUERIES["json_packet_scan"].build(t)
    assert found.inputFiles() and all(f.endswith(".json.gz") for f in found.inputFiles())
    assert same_rows(found, QUERIES["flatten_packet"].build(t))
