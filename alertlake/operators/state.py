"""Per-source state: one row per source, built by partial aggregation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.functions import exprs as X
from alertlake.schema import SOURCE_STATE_SCHEMA

_STATE = SOURCE_STATE_SCHEMA.fieldNames()
_LATEST = "_latest"


def source_state(alerts: DataFrame, *, carry_forward: bool = False) -> DataFrame:
    """Rollup of deduplicated alerts.

    ``carry_forward`` keeps the last non-null association of a source; otherwise the one of
    its latest row is kept, null included (the form that reassociation tracking needs).
    """
    arrived = ["mjd", "alert_id"]
    kept = ["ss_object_id", "ss_object_reassoc_time_mjd"]

    def known(name: str) -> Column:
        when = F.when(F.col(name).isNotNull(), F.struct(*arrived))
        return F.max_by(name, when)

    # The latest row is shuffled once, as one struct, and not once for each of its columns.
    rolled = alerts.groupBy("dia_source_id").agg(
        F.min("mjd").alias("first_seen_mjd"),
        F.max(F.struct(*arrived, *(() if carry_forward else kept))).alias(_LATEST),
        F.count(F.lit(1)).alias("observation_count"),
        *[known(c).alias(c) for c in kept if carry_forward],
    )
    last = {c: F.col(c if carry_forward else f"{_LATEST}.{c}") for c in kept}
    return rolled.select(
        "dia_source_id",
        "first_seen_mjd",
        F.col(f"{_LATEST}.mjd").alias("last_seen_mjd"),
        "observation_count",
        last["ss_object_id"].alias("ss_object_id"),
        last["ss_object_reassoc_time_mjd"].alias("ss_object_reassoc_time"),
        F.col(f"{_LATEST}.alert_id").alias("last_alert_id"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """Combine state rows of several batches into one row per source."""
    latest = ["last_seen_mjd", "last_alert_id", "ss_object_id", "ss_object_reassoc_time"]
    merged = states.groupBy("dia_source_id").agg(
        F.min("first_seen_mjd").alias("first_seen_mjd"),
        F.sum("observation_count").alias("observation_count"),
        F.max(F.struct(*latest)).alias(_LATEST),
    )
    return merged.select(
        *[F.col(f"{_LATEST}.{c}").alias(c) if c in latest else F.col(c) for c in _STATE]
    )


def source_arcs(state: DataFrame) -> DataFrame:
    """State with arc length, most observed first."""
    arc = F.col("last_seen_mjd") - F.col("first_seen_mjd")
    return (
        state.withColumn("arc_length_days", arc)
        .select(
            "dia_source_id",
            "observation_count",
            "first_seen_mjd",
            "last_seen_mjd",
            "arc_length_days",
            "ss_object_id",
            "ss_object_reassoc_time",
        )
        .orderBy(F.col("observation_count").desc(), "dia_source_id")
    )


def sources_in_window(state: DataFrame, start_mjd: float, end_mjd: float) -> DataFrame:
    """Sources whose observed interval meets the window, newest first."""
    overlaps = (F.col("last_seen_mjd") >= start_mjd) & (F.col("first_seen_mjd") <= end_mjd)
    return state.where(overlaps).orderBy(F.col("last_seen_mjd").desc(), "dia_source_id")


def expire_state(
    state: DataFrame,
    days: float = 90,
    as_of: datetime | None = None,
    max_sources: int | None = None,
) -> DataFrame:
    """State without sources unseen for ``days``; optionally only the newest so many."""
    kept = state.where(F.col("last_seen_mjd") >= X.days_ago_mjd(days, as_of))
    if max_sources:
        kept = kept.orderBy(F.col("last_seen_mjd").desc(), "dia_source_id").limit(max_sources)
    return kept


def with_prior_state(alerts: DataFrame, state: DataFrame) -> DataFrame:
    """Alerts with the stored state of their source, if any (prefix ``prior_``)."""
    renamed = {c: f"prior_{c}" for c in _STATE if c != "dia_source_id" and c in state.columns}
    prior = state.withColumnsRenamed(renamed)
    return alerts.join(prior, "dia_source_id", "left").withColumn(
        "has_prior_state", F.col("prior_first_seen_mjd").isNotNull()
    )


def new_vs_updated(alerts: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """One row: new_sources, updated_sources. New is the first row of a source without state.

    Both sides of the join hold one row per source, so no key is hot in it.
    """
    counts = alerts.groupBy("dia_source_id").agg(F.count(F.lit(1)).alias("n"))
    if state is None:
        counts = counts.withColumn("known", F.lit(False))
    else:
        known = state.select("dia_source_id", F.lit(True).alias("known"))
        counts = counts.join(known, "dia_source_id", "left").fillna(False, ["known"])
    is_new = (~F.col("known")).cast("long")
    return counts.agg(
        F.coalesce(F.sum(is_new), F.lit(0)).alias("new_sources"),
        F.coalesce(F.sum(F.col("n") - is_new), F.lit(0)).alias("updated_sources"),
    )
