"""Compacted alert tables: what readers see, repeated runs, and boxes on the sky."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from alertlake.functions import sky
from alertlake.operators import presets, views
from alertlake.plans import compaction, ingest
from alertlake.plans.storage import Lake
from tests.test_lake import make_alerts


def spread(spark, ids):
    return make_alerts(
        spark, ids, ra=(F.col("id") * 7 % 360).cast("double"), dec=(F.col("id") * 11 % 181 - 90).cast("double")
    )


def seen(spark, lake):
    return sorted((r.alert_id, r.run_id) for r in lake.read(spark, "alerts").collect())


def test_runs_are_read_from_the_compaction(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), merge_at=3)
    want = []
    for k in range(4):
        ingest.ingest(spread(spark, range(k * 10, k * 10 + 12)), lake, run_id=f"r{k}")
        want += [(i, f"r{k}") for i in range(k * 10 + (2 if k else 0), k * 10 + 12)]
        if k % 2:
            before = seen(spark, lake)
            assert ingest.compact(spark, lake) == 2
            assert seen(spark, lake) == before
    assert seen(spark, lake) == sorted(want)
    assert ingest.compact(spark, lake) == 0
    assert compaction.live_runs(spark, lake) == [] and len(compaction.manifest(spark, lake).folders) == 2
    # a run that was compacted is repeated, and compacted again
    assert ingest.ingest(spread(spark, range(12)), lake, run_id="r0").alerts_ingested == 12
    again = sorted(want)
    assert seen(spark, lake) == again
    assert ingest.compact(spark, lake) == 1  # the third folder: all become one
    assert seen(spark, lake) == again
    assert len(compaction.manifest(spark, lake).folders) == 1
    ingest.ingest(spread(spark, range(60, 63)), lake, run_id="r9")
    ingest.compact(spark, lake)
    assert len(seen(spark, lake)) == len(again) + 3
    ingest.rebuild_state(spark, lake)
    assert ingest.current_state(spark, lake).agg(F.sum("observation_count")).first()[0] == len(again) + 3


def test_a_compaction_is_shared_by_the_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "LEAST_BYTES", 2000)
    lake = Lake(str(tmp_path / "lake"), partition_days=10_000)
    ingest.ingest(spread(spark, range(3000)), lake, run_id="a")
    ingest.compact(spark, lake)
    files = glob.glob(f"{tmp_path}/lake/compacted/*/mjd_day=*/*.parquet")
    assert len(files) == 2 * spark.sparkContext.defaultParallelism
    assert lake.read(spark, "alerts").count() == 3000


BOXES = [(10.0, 40.0, -30.0, 20.0, False), (340.0, 20.0, -5.0, 5.0, True), (0.0, 360.0, 85.0, 90.0, False)]


@pytest.mark.parametrize("box", [*BOXES, (350.0, 10.0, 0.0, 10.0, False), (200.0, 199.0, -90.0, 90.0, True)])
def test_cells_hold_the_box(spark, box):
    rows = spark.range(0, 361 * 37).select(
        (F.col("id") % 361).cast("double").alias("ra"), (F.floor(F.col("id") / 361) * 5 - 90).cast("double").alias("dec")
    ).withColumn("mjd", F.lit(1.0))
    plain = views.in_region(rows, *box[:4], wrap=box[4])
    celled = views.in_region(rows.withColumn(sky.CELL, sky.sky_cell(F.col("ra"), F.col("dec"))), *box[:4], wrap=box[4])
    pairs = lambda df: sorted((r.ra, r.dec) for r in df.collect())
    assert pairs(plain) == pairs(celled)


def test_boxes_skip_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "FILE_BYTES", 2000)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    lake = Lake(str(tmp_path / "lake"), partition_days=10_000)
    ingest.ingest(spread(spark, range(3000)), lake, run_id="a")
    ingest.compact(spark, lake)
    rows = lake.read(spark, "alerts")
    limits = []
    for path in glob.glob(f"{tmp_path}/lake/compacted/*/mjd_day=*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for k in range(meta.num_row_groups):
            columns = [meta.row_group(k).column(c) for c in range(meta.num_columns)]
            (cell,) = [c.statistics for c in columns if c.path_in_schema == sky.CELL]
            limits.append((cell.min, cell.max))
    assert len(limits) >= 20
    for ra_min, ra_max, dec_min, dec_max, wrap in BOXES:
        found = views.in_region(rows, ra_min, ra_max, dec_min, dec_max, wrap=wrap)
        ranges = sky.cells_of_box(ra_min, ra_max, dec_min, dec_max, wrap)
        opened = sum(any(low <= b and a <= high for a, b in ranges) for low, high in limits)
        assert opened < len(limits) / 2
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({sky.CELL},{ranges[0][0]})" in plan and found.count() > 0
    region = presets.sky_region(10.0, 40.0, -30.0, 20.0).apply(rows)
    assert f"GreaterThanOrEqual({sky.CELL}," in region._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert region.count() == views.in_region(rows, 10.0, 40.0, -30.0, 20.0).count()
