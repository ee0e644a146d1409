"""Rollups over the alert table. All aggregates combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.functions import exprs as X

def _count_true(flag: str) -> Column:
    return F.count_if(F.col(flag))


def _distinct(name: str, approx: bool) -> Column:
    return F.approx_count_distinct(name) if approx else F.count_distinct(name)


def alert_stats(alerts: DataFrame, *, approx: bool = False) -> DataFrame:
    """One row of overall statistics."""
    ext = F.col("extendedness_median")
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        _distinct("dia_source_id", approx).alias("unique_sources"),
        _distinct("dia_object_id", approx).alias("unique_objects"),
        F.min("mjd").alias("min_mjd"),
        F.max("mjd").alias("max_mjd"),
        F.avg(ext).alias("ext_mean"),
        F.stddev_samp(ext).alias("ext_std"),
        F.count_if(ext < X.POINT_MAX).alias("point_sources"),
        F.count_if(ext > X.EXTENDED_MIN).alias("extended_sources"),
        _count_true("has_ss_source").alias("with_sso"),
        F.count_if(~F.col("has_ss_source")).alias("without_sso"),
    )


def source_summary(
    alerts: DataFrame, *, group_by: str = "dia_object_id", min_alerts: int = 2
) -> DataFrame:
    """Per object (null key left out) with at least two alerts."""
    ext = F.col("extendedness_median")
    return (
        alerts.where(F.col(group_by).isNotNull())
        .groupBy(group_by)
        .agg(
            F.count(F.lit(1)).alias("detection_count"),
            F.min("mjd").alias("first_mjd"),
            F.max("mjd").alias("last_mjd"),
            F.avg(ext).alias("extendedness_mean"),
            F.stddev_samp(ext).alias("extendedness_std"),
            F.min(ext).alias("extendedness_lowest"),
            F.max(ext).alias("extendedness_highest"),
            # at most as many entries as there are bands
            F.sort_array(F.collect_set("filter_name")).alias("filters"),
            F.bool_or("has_ss_source").alias("has_sso_detection"),
        )
        .where(F.col("detection_count") >= min_alerts)
        .withColumn("time_span_days", F.col("last_mjd") - F.col("first_mjd"))
    )


def reassociation_pairs(flagged: DataFrame) -> DataFrame:
    """Per source and solar-system object among reassociated rows: the object lists of
    ``reassociation_tracker`` in row form, so that no source has to fit one record."""
    return (
        flagged.where("is_reassociation")
        .groupBy("dia_source_id", "ss_object_id")
        .agg(
            F.count(F.lit(1)).alias("reassociation_count"),
            F.min("mjd").alias("first_reassoc_mjd"),
            F.max("mjd").alias("last_reassoc_mjd"),
        )
    )


def reassociation_tracker(flagged: DataFrame, *, with_lists: bool = True) -> DataFrame:
    """Per source among reassociated rows, most reassociations first.

    The first step collapses equal (source, object, reason) rows, so the lists are built
    from distinct values only. ``with_lists=False`` leaves the object list out where a
    source may have more objects than fit one record; see ``reassociation_pairs``.
    """
    distinct = (
        flagged.where("is_reassociation")
        .groupBy("dia_source_id", "ss_object_id", "reassociation_reason")
        .agg(F.count(F.lit(1)).alias("n"), F.min("mjd").alias("lo"), F.max("mjd").alias("hi"))
    )
    columns = [
        F.sum("n").alias("reassociation_count"),
        F.min("lo").alias("first_reassoc_mjd"),
        F.max("hi").alias("last_reassoc_mjd"),
        F.count_distinct("ss_object_id").alias("ss_object_count"),
        F.sort_array(F.collect_set("reassociation_reason")).alias("reasons"),
    ]
    if with_lists:
        columns.append(F.sort_array(F.collect_set("ss_object_id")).alias("ss_objects"))
    return (
        distinct.groupBy("dia_source_id")
        .agg(*columns)
        .orderBy(F.col("reassociation_count").desc(), "dia_source_id")
    )


def sso_summary(flagged: DataFrame, *, approx: bool = False) -> DataFrame:
    """Per solar-system object, the null id included; most alerts first."""
    return (
        flagged.where("has_ss_source")
        .groupBy("ss_object_id")
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            _distinct("dia_source_id", approx).alias("source_count"),
            F.min("mjd").alias("first_mjd"),
            F.max("mjd").alias("last_mjd"),
            F.avg("extendedness_median").alias("avg_extendedness"),
            _count_true("is_reassociation").alias("reassociations"),
        )
        .orderBy(F.col("alert_count").desc(), "ss_object_id")
    )


def storage_stats(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.min("mjd").alias("min_mjd"),
        F.max("mjd").alias("max_mjd"),
        _count_true("has_ss_source").alias("sso_count"),
        _count_true("is_reassociation").alias("reassociation_count"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def band_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("filter_name").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.avg("extendedness_median").alias("avg_extendedness"),
    )


def alerts_by_ingest_date(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy(F.to_date("ingested_at").alias("ingest_date"))
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.col("ingest_date").desc())
    )


def extendedness_classes(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(X.extendedness_class("extendedness_median").alias("class")).agg(
        F.count(F.lit(1)).alias("alert_count")
    )


def minimoon_arcs(alerts: DataFrame, min_observations: int = 3) -> DataFrame:
    """Per solar-system object of intermediate extendedness with enough observations."""
    ext = F.col("extendedness_median")
    return (
        alerts.where(
            F.col("has_ss_source")
            & F.col("ss_object_id").isNotNull()
            & ext.between(X.POINT_MAX, X.EXTENDED_MIN)
        )
        .groupBy("ss_object_id")
        .agg(
            F.count(F.lit(1)).alias("observation_count"),
            F.avg(ext).alias("mean_extendedness"),
            F.min("mjd").alias("first_mjd"),
            F.max("mjd").alias("last_mjd"),
        )
        .where(F.col("observation_count") >= min_observations)
    )


def dataset_stats(rows: DataFrame) -> DataFrame:
    """One row: size, column names by family, association counts and rates."""
    names = rows.columns
    flags = {
        "is_reassociation": "reassociation",
        "isReassociation": "reassociation",
        "has_ss_source": "sso",
        "hasSSSource": "sso",
    }
    measures = [F.count(F.lit(1)).alias("rows")]
    for flag, label in flags.items():
        if flag in names:
            as_long = F.col(flag).cast("boolean").cast("long")
            measures += [
                F.coalesce(F.sum(as_long), F.lit(0)).alias(f"{label}_count"),
                F.avg(as_long).alias(f"{label}_rate"),
            ]

    def listed(prefix: str) -> Column:
        found = [F.lit(n) for n in names if n.startswith(prefix)]
        return F.array(*found) if found else F.array().cast("array<string>")

    return rows.agg(*measures).select(
        "*",
        F.lit(len(names)).alias("columns"),
        listed("").alias("column_names"),
        listed("trail").alias("trail_columns"),
        listed("pixelFlags").alias("pixel_flag_columns"),
    )
