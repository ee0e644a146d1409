"""Group processors on skewed keys."""

from pyspark.sql import functions as F

from alertlake.queryset_io import SpanByObject


def test_span_of_a_hot_object_is_not_held_whole(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100)
    rows = spark.range(0, 60000, 1, 8).select(
        hot.alias("dia_object_id"), (50000.0 + F.col("id") / 8).alias("mjd")
    )
    # An object of two rows, one of a single row, and a row without an object.
    more = spark.createDataFrame(
        [(1, 50001.0), (1, 50003.5), (2, 5e4), (None, 5e4)], "dia_object_id long, mjd double"
    )
    out = SpanByObject().run(rows.unionByName(more), 0.0, 1e6)
    assert sorted(map(tuple, out.collect())) == [(1, 2, 2.5), (7, 20000, 59997 / 8)]
    assert "InPandas" not in out._jdf.queryExecution().toString()
