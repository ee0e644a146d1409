"""Retention: archives of several expiries, and expiries that broke off."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from alertlake.plans import export, storage

AS_OF, LATER = date(2024, 1, 10), date(2024, 1, 11)


def store(spark, path, ids, mode="overwrite", **more):
    rows = spark.createDataFrame([(i,) for i in ids], "id long").withColumns(
        {"dia_source_id": F.col("id"), "mjd": F.lit(60000.5) + F.col("id") % 2, **more}
    )
    storage.write_by_day(rows, path, mode)


def expire(spark, path, archive, as_of=AS_OF):
    return export.expire(spark, path, 30, archive=archive, as_of=as_of, dry_run=False)


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def test_late_rows_and_other_runs_stay_in_the_archive(spark, tmp_path):
    runs, archive = [str(tmp_path / f"live/run_id={n}") for n in "ab"], str(tmp_path / "archive")
    store(spark, runs[0], range(4))
    store(spark, runs[1], range(10, 14))
    assert len(expire(spark, runs[0], archive)) == 2
    store(spark, runs[0], [4], "append", late=F.lit(True))
    store(spark, runs[0], [5, 7], "append")
    expire(spark, runs[0], archive)
    expire(spark, runs[1], archive)
    assert expire(spark, runs[1], archive, LATER) == []
    assert ids(spark, archive) == [0, 1, 2, 3, 4, 5, 7, 10, 11, 12, 13]
    whole = spark.read.option("mergeSchema", True).parquet(archive)
    assert [r["id"] for r in whole.where("late").collect()] == [4]


@pytest.mark.parametrize("at", ["write_text", "drop_files"])
def test_expiry_that_broke_off_doubles_nothing(spark, tmp_path, monkeypatch, at):
    live, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    store(spark, live, range(4))
    drop = storage.drop_files

    def broken(spark, *given):
        if at == "drop_files":
            drop(spark, given[0][:1])
        raise OSError("broke off")

    with monkeypatch.context() as patch:
        patch.setattr(storage, at, broken)
        with pytest.raises(OSError):
            expire(spark, live, archive)
    store(spark, live, [4, 5], "append")
    expire(spark, live, archive, LATER)
    assert ids(spark, archive) == [0, 1, 2, 3, 4, 5]
    assert storage.data_files(spark, live) == []
