"""Duplicate removal and latest-per-key.

``row_number() <= 1`` over a key is planned with a group limit on the map side, so a group
of copies reaches the shuffle as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.schema import ALERT_KEY

_RN = "_rn"
#: What the copies of an alert are ordered by, before ``row_hash`` of their other columns.
ARRIVAL = ("ingested_at", "mjd")


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN)


def row_hash(rows: DataFrame, skip: Sequence[str]) -> Column:
    """Last tie-break. Maps cannot be hashed or ordered, so they go in as JSON."""
    parts = [
        F.to_json(f.name) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
        for f in rows.schema.fields
        if f.name not in skip
    ]
    return F.xxhash64(*parts) if parts else F.lit(0)


def dedupe_alerts(alerts: DataFrame, order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Keep the first row of every (alert_id, dia_source_id)."""
    if order_by is None:
        lead = [c for c in ARRIVAL if c in alerts.columns]
        order_by = [*lead, row_hash(alerts, (*ALERT_KEY, *lead))]
    return first_per_key(alerts, ALERT_KEY, order_by)


def dedupe_by_column(
    rows: DataFrame, column: str | None, order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """First row per value of a column (null is a value too), or whole-row duplicates."""
    if column is None:
        return rows.dropDuplicates()
    return first_per_key(rows, [column], order_by or [row_hash(rows, (column,))])


def latest_per_key(
    rows: DataFrame, keys: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """The newest row per key: results per processor, filters per name, events per run."""
    return first_per_key(rows, keys, [F.col(c).desc() for c in newest])
