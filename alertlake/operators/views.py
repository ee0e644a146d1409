"""Named queries over the alert table: each is ``alerts -> DataFrame``."""

from __future__ import annotations

import math
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.functions import exprs as X
from alertlake.functions import sky
from alertlake.operators import filters as f
from alertlake.operators import presets as P


def _instant(as_of: datetime | None):
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def _by_mjd(rows: DataFrame, desc: bool) -> DataFrame:
    return f.FilterConfig(order_by="mjd", order_desc=desc).apply(rows)


def point_sources(alerts: DataFrame) -> DataFrame:
    return P.point_sources().apply(alerts, ordered=False)


def extended_sources(alerts: DataFrame) -> DataFrame:
    return P.extended_sources().apply(alerts, ordered=False)


def minimoon_candidates(alerts: DataFrame) -> DataFrame:
    return P.minimoon_candidates().apply(alerts, ordered=False)


def recent_ingest(alerts: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """Ingested in the last days, newest first."""
    start = _instant(as_of) - F.make_dt_interval(F.lit(days))
    return f.FilterConfig(order_by="ingested_at").apply(
        alerts.where(F.col("ingested_at") >= start)
    )


def today_ingest(alerts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Ingested on the day of ``as_of``: a range on the raw column, which can be pushed down."""
    start = F.date_trunc("day", _instant(as_of))
    seen = F.col("ingested_at")
    rows = alerts.where((seen >= start) & (seen < start + F.make_dt_interval(F.lit(1))))
    return f.FilterConfig(order_by="ingested_at").apply(rows)


def reassociations(alerts: DataFrame) -> DataFrame:
    return P.reassociations().apply(alerts)


def sso_alerts(alerts: DataFrame) -> DataFrame:
    return P.sso_alerts().apply(alerts)


def recent(alerts: DataFrame, days: float = 7, as_of: datetime | None = None) -> DataFrame:
    return _by_mjd(f.prune_days(alerts, X.days_ago_mjd(days, as_of), None), desc=True)


def by_source(alerts: DataFrame, dia_source_id: int) -> DataFrame:
    """Light curve of one source."""
    return _by_mjd(alerts.where(F.col("dia_source_id") == dia_source_id), desc=False)


def by_object(alerts: DataFrame, dia_object_id: int) -> DataFrame:
    return _by_mjd(alerts.where(F.col("dia_object_id") == dia_object_id), desc=False)


def by_sso(alerts: DataFrame, ss_object_id: str) -> DataFrame:
    return _by_mjd(alerts.where(F.col("ss_object_id") == ss_object_id), desc=False)


def in_region(
    alerts: DataFrame,
    ra_min: float,
    ra_max: float,
    dec_min: float,
    dec_max: float,
    *,
    wrap: bool = False,
) -> DataFrame:
    """Inclusive box. With ``wrap`` a box with ra_min > ra_max crosses 0/360."""
    if wrap and ra_min > ra_max:
        ra = (F.col("ra") >= ra_min) | (F.col("ra") <= ra_max)
    else:
        ra = F.col("ra").between(ra_min, ra_max)
    inside = ra & F.col("dec").between(dec_min, dec_max)
    if sky.CELL in alerts.columns:  # a stored table is sorted by cell: most of it is skipped
        inside &= sky.in_cells(sky.cells_of_box(ra_min, ra_max, dec_min, dec_max, wrap))
    return _by_mjd(alerts.where(inside), desc=True)


def in_time_window(alerts: DataFrame, start_mjd: float, end_mjd: float) -> DataFrame:
    return _by_mjd(f.prune_days(alerts, start_mjd, end_mjd), desc=False)


def with_filter(alerts: DataFrame, band: str) -> DataFrame:
    return P.by_filter_band(band).apply(alerts)


def high_snr(alerts: DataFrame, min_snr: float = 50.0) -> DataFrame:
    return P.high_snr(min_snr).apply(alerts)


def processing_window(
    alerts: DataFrame, days: float = 15, limit: int | None = None
) -> DataFrame:
    """Rows within ``days`` of the newest mjd, newest first. The maximum is a scalar
    subquery; on a table with noted day partitions it is taken from the newest one and
    bounds the partitions that are read."""
    newest, width = F.max("mjd").alias("newest"), f.day_width(alerts)
    if width is not None:
        last_day = alerts.agg(F.max("mjd_day")).scalar()
        start = alerts.where(F.col("mjd_day") == last_day).agg(newest - days).scalar()
        rows = alerts.where(F.col("mjd") >= start)
        rows = rows.where(F.col("mjd_day") >= last_day - F.lit(math.ceil(days) + width))
    else:
        rows = alerts.where(F.col("mjd") >= alerts.agg((F.max("mjd") - days).alias("s")).scalar())
    return f.FilterConfig(order_by="mjd", limit=limit).apply(rows)


def processing_results(
    results: DataFrame, processor: str | None = None, limit: int | None = 100
) -> DataFrame:
    """Newest processor runs."""
    if processor is not None:
        results = results.where(F.col("processor_name") == processor)
    out = results.orderBy(F.col("processed_at").desc(), "processor_name", "run_id")
    return out.limit(limit) if limit else out


_VIEWS = {
    "v_point_sources": point_sources,
    "v_extended_sources": extended_sources,
    "v_minimoon_candidates": minimoon_candidates,
    "v_recent_alerts": recent_ingest,
    "v_today_alerts": today_ingest,
    "v_reassociations": reassociations,
    "v_sso_alerts": sso_alerts,
}


def register_views(alerts: DataFrame, **tables: DataFrame) -> list[str]:
    """Temp views ``alerts_raw`` and ``v_*`` (plus any further tables) for ``custom``."""
    frames = {"alerts_raw": alerts, **{n: make(alerts) for n, make in _VIEWS.items()}, **tables}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)


def custom(spark: SparkSession, sql: str, params: list[Any] | dict[str, Any] | None = None):
    """SQL with positional (``?``) or named parameters over registered views."""
    return spark.sql(sql, args=params or None)
