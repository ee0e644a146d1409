"""Exact medians per group without holding a group in one task: rank selection by histograms.

Rows are counted by value once, into a stored table. Of each group a bracket is known that holds
the middle, at first all its values. As long as some group has more values in its bracket than a task should
get, they are counted in ``BINS`` ranges, and the bracket narrows to the range that holds the middle; where the
two middle values lie in different ranges, they are the ends of these. What is left is then read off
running counts. Ranges are even steps of the logarithm first, which reaches any size of numbers, then of
the value; infinities and NaN, which is above all, have ranges of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlake.session import scratch_path

BINS = 4096
#: A group with this many distinct values left in its bracket is finished by one running count.
VALUES_PER_TASK = 1_000_000


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _magnitude(v: Column) -> Column:
    """Rises with ``v``, between -1100 and 1100 for all numbers."""
    sized = F.signum(v) * F.log2(F.abs(v) * F.lit(2.0**20) + 1)
    return F.when(F.isnan(v), 1100.0).when(F.abs(v) == float("inf"), F.signum(v) * 1090.0).otherwise(
        F.least(F.greatest(sized, F.lit(-1080.0)), F.lit(1080.0))
    )


def _bin(first: bool) -> Column:
    """Number of the range of ``v`` between ``lo`` and ``hi``, which differ."""
    step = lambda scale: F.try_divide(
        scale(F.col("v")) - scale(F.col("lo")), scale(F.col("hi")) - scale(F.col("lo"))
    )
    even = step(lambda v: v)
    share = F.coalesce(step(_magnitude), even) if first else even
    return F.least(F.floor(share * BINS), F.lit(BINS - 1))


def _running(group: Sequence[str], order: Column) -> Column:
    """Rows up to this one, with those below the bracket."""
    window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.col("below") + F.sum("c").over(window)


def _ranks() -> tuple[Column, Column]:
    return F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)


def _narrowed(counts: DataFrame, wide: DataFrame, group: Sequence[str], first: bool) -> DataFrame:
    """The brackets of ``wide`` after one more histogram."""
    inside = counts.join(F.broadcast(wide), list(group)).where(F.col("v").between(F.col("lo"), F.col("hi")))
    bins = inside.groupBy(*group, _bin(first).alias("bin")).agg(
        F.sum("c").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"),
        F.count(F.lit(1)).alias("values"), F.first("n").alias("n"), F.first("below").alias("below"),
    )
    upto = bins.withColumn("upto", _running(group, F.col("bin")))
    before = F.col("upto") - F.col("c")
    low, high = _ranks()
    holds = lambda rank: (before <= rank) & (rank < F.col("upto"))
    of = lambda rank, value: F.max(F.when(holds(rank), value))
    found = upto.groupBy(*group).agg(
        F.first("n").alias("n"),
        (of(low, F.col("bin")) == of(high, F.col("bin"))).alias("one"),
        of(low, before).alias("before"),
        of(low, F.col("values")).alias("values"),
        of(low, F.col("least")).alias("least"), of(low, F.col("most")).alias("most"),
        of(high, F.col("least")).alias("next"),
    )
    # In one range the middle is still between its ends; in two it is the ends that meet.
    return found.select(
        *group, "n",
        F.col("before").alias("below"),
        F.when(F.col("one"), F.col("least")).alias("lo"), F.when(F.col("one"), F.col("most")).alias("hi"),
        F.when(F.col("one"), F.col("values")).otherwise(0).alias("values"),
        F.when(~F.col("one"), F.col("most")).alias("a"), F.when(~F.col("one"), F.col("next")).alias("b"),
    )


def exact_medians(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], values_per_task: int = VALUES_PER_TASK
) -> DataFrame:
    """(keys, <column>_median ...), nulls ignored. ``keys`` have a bounded number of values
    (dates, bands), which is what makes the broadcast of the brackets safe."""
    pairs = [F.struct(F.lit(c).alias("m"), F.col(c).cast("double").alias("v")) for c in columns]
    values = rows.select(*keys, F.inline(F.array(*pairs))).where(F.col("v").isNotNull())
    group = [*keys, "m"]
    counts = _stored(values.groupBy(*group, "v").agg(F.count(F.lit(1)).alias("c")), "values")
    none = F.lit(None).cast("double")
    brackets = _stored(
        counts.groupBy(*group).agg(
            F.sum("c").alias("n"), F.lit(0).cast("long").alias("below"), F.min("v").alias("lo"),
            F.max("v").alias("hi"), F.count(F.lit(1)).alias("values"),
        ).withColumns({"a": none, "b": none}),
        "brackets",
    )
    first = True
    while not brackets.where(F.col("values") > values_per_task).isEmpty():
        wide = F.col("values") > values_per_task
        narrowed = _narrowed(counts, brackets.where(wide), group, first)
        brackets = _stored(brackets.where(~wide).unionByName(narrowed), "brackets")
        first = False

    # The rest by running counts; one shuffle by the keys serves them and the columns of the result.
    rest = counts.join(F.broadcast(brackets), group).where(
        F.col("a").isNull() & F.col("v").between(F.col("lo"), F.col("hi"))
    )
    known = brackets.where(F.col("a").isNotNull()).select(*keys, "m", "a", "b")
    upto = rest.repartition(*keys).withColumn("upto", _running(group, F.col("v")))
    before = F.col("upto") - F.col("c")
    low, high = _ranks()
    at = lambda rank: F.when((before <= rank) & (rank < F.col("upto")), F.col("v"))
    read = upto.select(*keys, "m", at(low).alias("a"), at(high).alias("b"))
    is_m = lambda c: F.col("m") == c
    middle = lambda c: (F.max(F.when(is_m(c), F.col("a"))) + F.max(F.when(is_m(c), F.col("b")))) / 2
    return (
        reduce(DataFrame.unionByName, [read, known])
        .groupBy(*keys)
        .agg(*[middle(c).alias(f"{c}_median") for c in columns])
    )
