"""Solar-system (re)association: history per source, recency flag, broker pass filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.operators import skew
from alertlake.schema import ARRIVAL_ORDER

# Reason codes, and the tags that stand for an association.
NEW, CHANGED, UPDATED = "new_association", "changed_association", "updated_reassociation"
LOCUS_TAGS = ("solar_system", "sso", "asteroid", "comet", "neo", "mba")
PASS_FILTER_TAGS = ("solar_system", "sso", "asteroid", "comet")

RECENT_DAYS = 1.0

_ID, _TIME = "ss_object_id", "ss_object_reassoc_time_mjd"
_SOURCE, _STORED = "_source", "_stored"


def reason_for(prev_id: Column, prev_time: Column, now_id: Column, now_time: Column) -> Column:
    """Reason code against the previous observation, null if nothing changed."""
    return (
        F.when(prev_id.isNull() & now_id.isNotNull(), NEW)
        .when(prev_id != now_id, CHANGED)
        .when(prev_time != now_time, UPDATED)
    )


def detect_reassociations(
    alerts: DataFrame,
    prior_state: DataFrame | None = None,
    *,
    probe: DataFrame | None = None,
    small_batch: bool = False,
    any_hot: bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """Set is_reassociation, reassociation_reason and is_new_source on deduplicated alerts.

    Each row is compared with the row before it, by (mjd, alert_id), of the same source;
    the first row of a source with its stored state, if it has one. Without a hot source the
    state is joined on the partitions of the window; else it joins the window as one more row
    that precedes all others, so that no hot source has to meet in a join.
    ``probe`` is a cheaper superset of the alerts, from which the sources are taken whose
    state is wanted; ``small_batch`` says that its row count was checked, so that its source
    ids are broadcast to the stored state. ``any_hot=False`` says that no source is hot
    (``skew.has_hot_key``), ``tasks`` how many tasks share the rows.
    """
    rows = alerts.drop("is_reassociation", "reassociation_reason")
    seed = prior_state
    if seed is not None:
        seen = (alerts if probe is None else probe).select("dia_source_id").distinct()
        if small_batch:
            seed = seed.join(F.broadcast(seen), "dia_source_id", "left_semi")
        elif any_hot:
            seed = seed.join(seen, "dia_source_id", "left_semi")
        seed = seed.select(
            "dia_source_id",
            F.lit(float("-inf")).alias("mjd"),
            F.lit(-(2**63)).alias("alert_id"),
            F.col("ss_object_id").alias(_ID),
            F.col("ss_object_reassoc_time").alias(_TIME),
        )
        if any_hot:
            rows = rows.unionByName(seed, allowMissingColumns=True)
    out = skew.with_previous(
        rows,
        "dia_source_id",
        ARRIVAL_ORDER,
        (_ID, _TIME),
        tasks=tasks,
        any_hot=any_hot,
    )
    if seed is not None and any_hot:
        out = out.where(F.col("mjd") != float("-inf"))
    elif seed is not None:
        stored = seed.groupBy(F.col("dia_source_id").alias(_SOURCE)).agg(F.max(F.struct(_ID, _TIME)).alias(_STORED))
        out = (
            out.join(stored, F.col("dia_source_id") == F.col(_SOURCE), "left")
            .withColumn(skew.PREVIOUS, F.coalesce(skew.PREVIOUS, _STORED))
            .drop(_SOURCE, _STORED)
        )
    prev = F.col(skew.PREVIOUS)
    seen_before = prev.isNotNull()
    reason = F.when(
        seen_before, reason_for(prev[_ID], prev[_TIME], F.col(_ID), F.col(_TIME))
    )
    return (
        out.withColumn("reassociation_reason", reason)
        .withColumn("is_reassociation", F.col("reassociation_reason").isNotNull())
        .withColumn("is_new_source", ~seen_before)
        .drop(skew.PREVIOUS)
    )


def recent_association(has_sso: Column, reassoc: Column, observed: Column, days: float) -> Column:
    """True/false, never null."""
    near = F.abs(reassoc - observed) <= days
    return F.coalesce(has_sso & near, F.lit(False))


def flag_recent(alerts: DataFrame, days: float = RECENT_DAYS) -> DataFrame:
    """Flag an association (re)made within ``days`` of the observation."""
    hit = recent_association(F.col("has_ss_source"), F.col(_TIME), F.col("mjd"), days)
    gap = F.abs(F.col(_TIME) - F.col("mjd"))
    text = F.format_string("Recent SSObject reassociation (dt=%.3f days)", gap)
    return alerts.withColumn("is_reassociation", hit).withColumn(
        "reassociation_reason", F.when(hit, text)
    )


@dataclass(frozen=True)
class PassFilter:
    """Thresholds of the broker pass filter; ``reassociation`` False gives its first version."""

    median_low: float = 0.0
    median_high: float = 1.0
    min_low: float = 0.0
    max_high: float = 1.0
    require_sso: bool = True
    window_days: float = RECENT_DAYS
    reassociation: bool = True

    def column(
        self,
        median: Column,
        low: Column,
        high: Column,
        has_sso: Column,
        reassoc: Column,
        observed: Column,
    ) -> Column:
        known = median.isNotNull() & low.isNotNull() & high.isNotNull()
        in_range = (
            median.between(self.median_low, self.median_high)
            & (low >= self.min_low)
            & (high <= self.max_high)
        )
        if not self.require_sso:
            passes = ~has_sso & in_range
        elif self.reassociation:
            recent = recent_association(has_sso, reassoc, observed, self.window_days)
            passes = has_sso & (in_range | recent)
        else:
            passes = has_sso & in_range
        return F.coalesce(known & passes, F.lit(False))

    def on_alerts(self, alerts: DataFrame) -> DataFrame:
        test = self.column(
            F.col("extendedness_median"),
            F.col("extendedness_min"),
            F.col("extendedness_max"),
            F.coalesce(F.col("has_ss_source"), F.lit(False)),
            F.col(_TIME),
            F.col("mjd"),
        )
        return alerts.where(test)

    def on_loci(self, loci: DataFrame) -> DataFrame:
        """Loci whose latest alert passes. Association: properties, packet, exact tags."""
        last = F.try_element_at("alerts", F.lit(-1))
        props, packet_sso = last["properties"], last["packet"]["ssObject"]
        by_props = props["ssObjectId"].isNotNull()
        by_packet = struct_present(packet_sso)
        by_tag = F.coalesce(
            F.arrays_overlap("tags", F.array(*[F.lit(t) for t in PASS_FILTER_TAGS])), F.lit(False)
        )
        own_time = props["ssObjectReassocTimeMjdTai"]
        time = F.when(by_props, own_time).otherwise(
            F.coalesce(own_time, F.when(by_packet, packet_sso["ssObjectReassocTimeMjdTai"]))
        )
        test = self.column(
            props["extendednessMedian"],
            props["extendednessMin"],
            props["extendednessMax"],
            by_props | by_packet | by_tag,
            time,
            props["midPointTai"],
        )
        return loci.where(test)


def struct_present(value: Column, fields: tuple[str, ...] = ("ssObjectId", "ssObjectReassocTimeMjdTai")):
    """A struct counts as present if any of its fields is set."""
    found = F.lit(False)
    for name in fields:
        found = found | value[name].isNotNull()
    return found


def association_by_tag(tags: Column) -> Column:
    lowered = F.transform(tags, lambda t: F.lower(t))
    known = F.array(*[F.lit(t) for t in LOCUS_TAGS])
    return F.coalesce(F.arrays_overlap(lowered, known), F.lit(False))


