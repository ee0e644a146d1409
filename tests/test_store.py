"""The key store: buckets that a batch opens, merges, repeated and broken runs."""

import pytest
from pyspark.sql import functions as F

from alertlake.operators import filters
from alertlake.plans import catalog, ingest, storage
from alertlake.plans.storage import Lake
from alertlake.plans.store import Store, buckets_of, hash_of
from tests.test_lake import make_alerts


def counts(spark, lake):
    rows = lake.read(spark, "alerts")
    state = ingest.current_state(spark, lake)
    keys = Store.read(spark, lake).keys()
    return rows.count(), keys.count(), keys.distinct().count(), state.agg(F.sum("observation_count")).first()[0]


def test_a_batch_opens_its_own_buckets(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), bucket_rows=20)
    ingest.ingest(make_alerts(spark, range(600)), lake, run_id="a")
    store = Store.read(spark, lake)
    (segment,) = store.manifest.segments
    assert segment.buckets == 32 and segment.rows == 600
    hashes = [r[0] for r in spark.range(600).select(hash_of("id")).collect()]
    two = {hashes[0] % 32, next(h % 32 for h in hashes if h % 32 != hashes[0] % 32)}
    asked = [h for h in hashes if h % 32 in two]
    listed = store.folders("keys", segment, asked)
    assert {int(x.rsplit("=", 1)[1]) for x in listed} == two
    plan = store.keys(asked)._jdf.queryExecution().executedPlan().toString()
    assert f"InMemoryFileIndex(2 paths)" in plan
    found = store.keys(asked)
    assert {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()} == {str(b) for b in two}
    want = {i for i, h in enumerate(hashes) if h % 32 in two}
    assert {r.alert_id for r in found.collect()} == want


def test_small_buckets_stay_few():
    """A bucket is a folder: many are made only where each has many rows."""
    assert [buckets_of(n, 4000) for n in (1, 4001, 600_000, 10**6, 10**8, 10**9)] == [1, 2, 256, 256, 256, 1024]
    assert [buckets_of(n, 1_000_000) for n in (10**6, 3 * 10**8, 10**11)] == [1, 512, 4096]


def test_segments_merge_and_runs_repeat(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), bucket_rows=10, merge_at=2)
    for k in range(5):
        ingest.ingest(make_alerts(spark, range(k * 10, k * 10 + 15)), lake, run_id=f"r{k}")
    store = Store.read(spark, lake)
    assert len(store.manifest.segments) < 5 and counts(spark, lake) == (55, 55, 55, 55)
    # the newest run has a segment of its own: it can be repeated as it is
    assert ("r4",) in {s.runs for s in store.manifest.segments}
    before = sorted(ingest.current_state(spark, lake).collect())
    for run in ("r4", "r0"):  # and one that was merged: the store is built anew
        ingest.ingest(make_alerts(spark, range(40, 55) if run == "r4" else range(0, 15)), lake, run_id=run)
        assert counts(spark, lake) == (55, 55, 55, 55)
    assert sorted(ingest.current_state(spark, lake).collect()) == before
    # no folder is left that the manifest does not know
    store = Store.begin(spark, lake, "none")
    known = {s.name for s in store.manifest.segments} | set(store.manifest.retired)
    folders = storage.subdirectories(spark, lake.path("store"))
    assert {f.rsplit("/", 1)[1] for f in folders} <= known


def test_broken_runs_are_settled(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    ingest.ingest(make_alerts(spark, range(5)), lake, run_id="a")
    with monkeypatch.context() as m:
        m.setattr(Store, "finish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest(make_alerts(spark, range(10)), lake, run_id="b")
    assert Store.read(spark, lake).manifest.pending == ("b",)
    assert ingest.dry_run(make_alerts(spark, range(12)), lake).first()[0] == 2
    # another run sees what the broken one has stored
    assert ingest.ingest(make_alerts(spark, range(12)), lake, run_id="c").alerts_ingested == 2
    assert counts(spark, lake) == (12, 12, 12, 12)
    assert ingest.ingest(make_alerts(spark, range(10)), lake, run_id="b").alerts_ingested == 5
    assert counts(spark, lake) == (12, 12, 12, 12)


def test_lakes_from_before_the_store(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    ingest.ingest(make_alerts(spark, range(8)), lake, run_id="a")
    storage.drop_directory(spark, lake.path("store"))
    assert ingest.ingest(make_alerts(spark, range(10)), lake, run_id="b").alerts_ingested == 2
    assert counts(spark, lake) == (10, 10, 10, 10)


def test_saved_filters_share_one_scan_of_unseen_runs(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    saved = catalog.FilterCatalog(spark, lake)
    configs = [filters.FilterConfig(name=f"f{k}", conditions=(filters.ge("alert_id", k),)) for k in range(10)]
    for config in configs:
        saved.save(config)
    ingest.ingest(make_alerts(spark, range(12)), lake, run_id="a")
    runs = {c.config_hash(): {"a"} for c in configs}
    plan = catalog.catalog_matches(spark, lake, configs, runs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert catalog.materialize_catalog(spark, lake) == {f"f{k}": 12 - k for k in range(10)}
    ingest.ingest(make_alerts(spark, range(15)), lake, run_id="b")
    # broken off after the keys were written, before the note
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Lake, "append_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            catalog.materialize_catalog(spark, lake)
    assert catalog.materialize_catalog(spark, lake) == {f"f{k}": 3 for k in range(10)}
    assert not any(catalog.materialize_catalog(spark, lake).values())
    stored = lake.read(spark, "filtered")
    assert stored.count() == stored.distinct().count() == sum(15 - k for k in range(10))
    # a filter that is saved later looks at all runs, and not at keys stored by hand
    late = filters.FilterConfig(name="late", conditions=(filters.lt("alert_id", 4),))
    assert catalog.materialize_filter(make_alerts(spark, range(2)), late, lake) == (2, 2)
    saved.save(late)
    assert catalog.materialize_catalog(spark, lake)["late"] == 2
    saved.save(filters.FilterConfig(name="top", limit=3))
    with pytest.raises(ValueError):
        catalog.materialize_catalog(spark, lake)
