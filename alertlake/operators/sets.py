"""Set operations between alert tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def concat_differing(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of differing column sets; missing values are null, columns in name order."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(*sorted(merged.columns))


def distinct_rows(rows: DataFrame) -> DataFrame:
    return rows.dropDuplicates()


def not_stored(
    alerts: DataFrame,
    stored: DataFrame,
    *,
    keys: Sequence[str] = ("alert_id",),
    small_batch: bool = False,
) -> DataFrame:
    """Alerts whose key is not stored yet.

    ``small_batch`` is for batches whose row count was checked: their keys are broadcast to
    the stored table, which is then only scanned (key columns) and never shuffled; only the
    hits come back, at most one per batch row. Otherwise both sides shuffle by key.
    """
    on = list(keys)
    known = stored.select(*on)
    if not small_batch:
        return alerts.join(known, on, "left_anti")
    wanted = F.broadcast(alerts.select(*on).distinct())
    hits = known.join(wanted, on, "left_semi").distinct()
    return alerts.join(F.broadcast(hits), on, "left_anti")


def stored_rows_of(filtered: DataFrame, alerts: DataFrame) -> DataFrame:
    """Full rows of materialised filter keys."""
    keys = filtered.select("alert_id", "dia_source_id")
    return alerts.join(keys, ["alert_id", "dia_source_id"], "left_semi")
