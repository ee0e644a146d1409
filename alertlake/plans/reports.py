"""Daily and monthly reports, and rollups of the run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.functions import exprs as X
from alertlake.operators.quantiles import exact_medians

BANDS = ("u", "g", "r", "i", "z", "y")  # fixed values: survey bands
_CUTOUTS = ("science", "template", "difference")


def _band_columns() -> list[Column]:
    """Alerts per known band; ``alerts_other`` covers any further band, so none is lost."""
    band, one = F.col("filter_name"), F.lit(1)
    cols = [F.count(F.when(band == b, one)).alias(f"alerts_{b}") for b in BANDS]
    return [*cols, F.count(F.when(~band.isin(*BANDS), one)).alias("alerts_other")]


def observing_date() -> Column:
    return X.mjd_to_date("mjd")


def daily_report(
    alerts: DataFrame, date: Column | None = None, *, medians: bool = True, approx: bool = False
) -> DataFrame:
    """One row per date (default: the observing date)."""
    dated = alerts.withColumn("date", observing_date() if date is None else date)
    ext, snr = F.col("extendedness_median"), F.col("snr")
    distinct = F.approx_count_distinct if approx else F.count_distinct
    stamps = [
        F.count(f"{t}_cutout_path").alias(f"{t}_cutouts")
        for t in _CUTOUTS
        if f"{t}_cutout_path" in alerts.columns
    ]
    report = dated.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_alerts"),
        distinct("dia_object_id").alias("unique_objects"),
        distinct("dia_source_id").alias("unique_sources"),
        *_band_columns(),
        F.count_if("has_ss_source").alias("with_sssource"),
        F.count_if(~F.col("has_ss_source")).alias("without_sssource"),
        F.avg(ext).alias("ext_mean"),
        F.stddev_samp(ext).alias("ext_std"),
        F.min(ext).alias("ext_min"),
        F.max(ext).alias("ext_max"),
        *stamps,
        F.min("ra").alias("ra_min"),
        F.max("ra").alias("ra_max"),
        F.min("dec").alias("dec_min"),
        F.max("dec").alias("dec_max"),
        F.avg("dec").alias("dec_mean"),
        F.avg("ps_flux").alias("flux_mean"),
        F.stddev_samp("ps_flux").alias("flux_std"),
        F.avg(snr).alias("snr_mean"),
        F.count_if(snr > 5).alias("snr_above_5"),
        F.count_if(snr > 10).alias("snr_above_10"),
    )
    area = X.sky_area(*[F.col(c) for c in ("ra_min", "ra_max", "dec_min", "dec_max", "dec_mean")])
    report = report.withColumn("area_sq_deg", area).drop("dec_mean")
    if medians:
        middle = exact_medians(dated, ["date"], ["ps_flux", "snr"]).withColumnRenamed(
            "ps_flux_median", "flux_median"
        )
        report = report.join(middle, "date", "left")
    return report


def band_counts_by_date(alerts: DataFrame, date: Column | None = None) -> DataFrame:
    """Long form of the band counts, for any set of bands."""
    return (
        alerts.where(F.col("filter_name").isNotNull())
        .groupBy((observing_date() if date is None else date).alias("date"), "filter_name")
        .agg(F.count(F.lit(1)).alias("alert_count"))
    )


def monthly_report(
    alerts: DataFrame, date: Column | None = None, *, approx: bool = False
) -> DataFrame:
    """One row per (year, month): rolled up from days, plus the distinct objects."""
    dated = alerts.withColumn("date", observing_date() if date is None else date)
    month = [F.year("date").alias("year"), F.month("date").alias("month")]
    days = dated.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("has_ss_source").alias("sso"),
        *_band_columns(),
    )
    bands = [f"alerts_{b}" for b in (*BANDS, "other")]
    months = days.groupBy(*month).agg(
        F.sum("n").alias("total_alerts"),
        F.count(F.lit(1)).alias("days_with_data"),
        F.avg("n").alias("avg_alerts_per_day"),
        F.max("n").alias("max_daily_alerts"),
        F.min("n").alias("min_daily_alerts"),
        *[F.sum(b).alias(b) for b in bands],
        F.sum("sso").alias("with_sssource"),
        (F.sum("sso") / F.sum("n")).alias("sso_fraction"),
    )
    distinct = F.approx_count_distinct if approx else F.count_distinct
    objects = dated.groupBy(*month).agg(distinct("dia_object_id").alias("unique_objects"))
    return months.join(objects, ["year", "month"])


#: Size of a sketch: 2**LOG_K registers, whose estimates are off by 1.04 / sqrt(2**LOG_K), about 0.8 %.
LOG_K = 14
SKETCH_ERROR = 1.04 / 2 ** (LOG_K / 2)


def daily_sketches(alerts: DataFrame, date: Column | None = None) -> DataFrame:
    """Per date a count and mergeable sketches of its objects and sources, some kilobytes each.

    Kept per day, they give distinct counts over any range of days without reading the alerts again;
    an object that is seen on many days counts once.
    """
    return alerts.groupBy((observing_date() if date is None else date).alias("date")).agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.hll_sketch_agg("dia_object_id", F.lit(LOG_K)).alias("objects"),
        F.hll_sketch_agg("dia_source_id", F.lit(LOG_K)).alias("sources"),
    )


def distinct_over(days: DataFrame, *by: Column) -> DataFrame:
    """(by, total_alerts, unique_objects, unique_sources) over rows of ``daily_sketches``: estimates."""
    return days.groupBy(*by).agg(
        F.sum("total_alerts").alias("total_alerts"),
        F.hll_sketch_estimate(F.hll_union_agg("objects")).alias("unique_objects"),
        F.hll_sketch_estimate(F.hll_union_agg("sources")).alias("unique_sources"),
    )


def monthly_from_sketches(days: DataFrame) -> DataFrame:
    return distinct_over(days, F.year("date").alias("year"), F.month("date").alias("month"))


def sky_area(alerts: DataFrame) -> DataFrame:
    """Area estimate of the whole table, one row."""
    ranges = alerts.agg(
        F.min("ra").alias("ra_min"),
        F.max("ra").alias("ra_max"),
        F.min("dec").alias("dec_min"),
        F.max("dec").alias("dec_max"),
        F.avg("dec").alias("dec_mean"),
    )
    area = X.sky_area(*[F.col(c) for c in ranges.columns])
    return ranges.withColumn("area_sq_deg", area)


def processing_summary(results: DataFrame) -> DataFrame:
    """Per processor and version, completed runs only."""
    return (
        results.where(F.col("status") == "completed")
        .groupBy("processor_name", "processor_version")
        .agg(
            F.count(F.lit(1)).alias("run_count"),
            F.max("processed_at").alias("last_run"),
            F.sum("record_count").alias("total_records"),
        )
    )


def ingestion_daily(runs: DataFrame) -> DataFrame:
    """Per start day, completed runs only, newest first. ``runs``: one row per run."""
    return (
        runs.where(F.col("status") == "completed")
        .groupBy(F.to_date("started_at").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.sum("alerts_ingested").alias("total_ingested"),
            F.sum("alerts_failed").alias("total_failed"),
            F.sum("new_sources").alias("total_new_sources"),
            F.sum("reassociations_detected").alias("total_reassociations"),
        )
        .orderBy(F.col("date").desc())
    )


def run_metrics(runs: DataFrame) -> DataFrame:
    """Duration, rate and success of each run. A run without alerts counts as a success."""
    seconds = (F.unix_micros("completed_at") - F.unix_micros("started_at")) / 1e6
    total = F.col("alerts_ingested") + F.col("alerts_failed")
    return (
        runs.withColumn("duration_seconds", seconds)
        .withColumn("processing_rate", X.per_second("alerts_ingested", "duration_seconds"))
        .withColumn("success_rate", X.percent("alerts_ingested", total, 100.0))
    )


def broker_day_summary(runs: DataFrame) -> DataFrame:
    """Per day over all runs: counters, runtime and rate."""
    measured = run_metrics(runs)
    out = measured.groupBy(F.to_date("started_at").alias("date")).agg(
        F.sum("alerts_received").alias("messages_processed"),
        F.sum("alerts_failed").alias("messages_failed"),
        F.sum("cutouts_saved").alias("cutouts_saved"),
        F.sum("alerts_ingested").alias("rows_written"),
        F.sum("new_sources").alias("new_sources"),
        F.sum("reassociations_detected").alias("reassociations_detected"),
        F.sum("duration_seconds").alias("runtime_seconds"),
    )
    rate = F.coalesce(X.per_second("messages_processed", "runtime_seconds"), F.lit(0.0))
    return out.withColumn("processing_rate", rate)
