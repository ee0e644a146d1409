"""Saved filters as an append-only log, and materialised filter results."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.operators.dedupe import latest_per_key
from alertlake.operators.filters import FilterConfig
from alertlake.plans import compaction
from alertlake.plans.storage import TABLES, Lake, count_rows, drop_directory, subdirectories
from alertlake.schema import ALERT_KEY
from alertlake.session import scratch_path


class FilterCatalog:
    """Name -> filter. The newest log row of a name wins; a deletion is a row as well."""

    def __init__(self, spark: SparkSession, lake: Lake) -> None:
        self.spark, self.lake = spark, lake

    def _log(self, config: FilterConfig, deleted: bool) -> None:
        row = {
            "name": config.name,
            "description": config.description,
            "config_json": config.to_json(),
            "deleted": deleted,
            "saved_at": datetime.now(timezone.utc),
            "seq": time.time_ns(),
        }
        self.lake.append_row(self.spark, "filters", row)

    def table(self) -> DataFrame:
        """The saved filters, by name."""
        newest = latest_per_key(self.lake.read(self.spark, "filters"), ["name"], ["seq"])
        return newest.where(~F.col("deleted")).orderBy("name")

    def save(self, config: FilterConfig) -> None:
        self._log(config, deleted=False)

    def load(self, name: str) -> FilterConfig | None:
        row = self.table().where(F.col("name") == name).first()
        return FilterConfig.from_json(row["config_json"]) if row else None

    def names(self) -> list[str]:
        return [r["name"] for r in self.table().select("name").collect()]

    def delete(self, name: str) -> bool:
        found = self.load(name)
        if found is not None:
            self._log(found, deleted=True)
        return found is not None

    def apply(self, name: str, alerts: DataFrame) -> DataFrame:
        config = self.load(name)
        if config is None:
            raise ValueError(f"no saved filter {name!r}")
        return config.apply(alerts)


def _store(found: DataFrame, lake: Lake, run_id: str) -> DataFrame:
    """``found`` (keys, filter_config, filter_config_hash) below a run folder; what was written."""
    path = lake.run_path("filtered", run_id)
    stamped = found.withColumn("filtered_at", F.lit(datetime.now(timezone.utc)).cast("timestamp"))
    stamped.write.mode("overwrite").partitionBy("filter_config_hash").parquet(path)
    return found.sparkSession.read.schema(TABLES["filtered"]).parquet(path)


def materialize_filter(
    alerts: DataFrame, config: FilterConfig, lake: Lake
) -> tuple[int, int]:
    """Store the keys of matching alerts under the hash of the filter.

    Returns (matched, newly written): keys stored before for the same filter stay as they
    are. Only the key columns and those in the predicate are read, once.
    """
    spark = alerts.sparkSession
    mark, staging = config.config_hash(), scratch_path(spark, "matched")
    config.apply(alerts, ordered=False).select(*ALERT_KEY).write.parquet(staging)
    keys = spark.read.parquet(staging)
    known = lake.read(spark, "filtered").where(F.col("filter_config_hash") == mark)
    fresh = keys.join(known.select(*ALERT_KEY), list(ALERT_KEY), "left_anti").select(
        *ALERT_KEY, F.lit(config.to_json()).alias("filter_config"), F.lit(mark).alias("filter_config_hash")
    )
    added = count_rows(_store(fresh, lake, f"filter-{uuid.uuid4().hex}"))
    matched = count_rows(keys)
    drop_directory(spark, staging)
    return matched, added


def catalog_matches(
    spark: SparkSession, lake: Lake, configs: list[FilterConfig], runs: dict[str, set[str]]
) -> DataFrame:
    """(keys, filter_config, filter_config_hash) of the alerts of ``runs`` that pass the filters.

    All filters are columns of one projection over one scan; a row leaves it once for each filter
    that it passes. ``runs`` names for each filter hash the ingest runs to look at.
    """
    wanted = sorted(set().union(*runs.values()))
    kind = TABLES["alerts"]
    rows = lake.read(spark, "alerts").where(F.col("run_id").isin(wanted))
    marks = []
    for config in configs:
        mark = config.config_hash()
        own = runs.get(mark, set())
        here = F.lit(True) if own == set(wanted) else F.col("run_id").isin(*sorted(own))
        filter_row = F.struct(F.lit(config.to_json()).alias("filter_config"), F.lit(mark).alias("filter_config_hash"))
        if own:
            marks.append(F.when(config.column(kind) & here, filter_row))
    passed = rows.select(*ALERT_KEY, F.array_compact(F.array(*marks)).alias("marks"))
    return passed.select(*ALERT_KEY, F.inline("marks"))


def materialize_catalog(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Store the keys that each saved filter finds in the ingest runs it has not seen; how many, by name.

    The run folder is named after the filters and runs that it covers, and is overwritten: what broke
    off is written again by the next call. Filters with a limit depend on all rows: they are refused.
    """
    configs = [FilterConfig.from_json(r["config_json"]) for r in FilterCatalog(spark, lake).table().collect()]
    limited = [c.name for c in configs if c.limit]
    if limited:
        raise ValueError(f"filters with a limit cannot be kept run by run: {', '.join(limited)}")
    stored = compaction.stored_runs(spark, lake)
    seen = {tuple(r) for r in lake.read(spark, "materialized").collect()}
    runs = {c.config_hash(): {r for r in stored if (c.config_hash(), r) not in seen} for c in configs}
    pairs = sorted((mark, run) for mark, own in runs.items() for run in own)
    if not pairs:
        return {c.name: 0 for c in configs}
    found = catalog_matches(spark, lake, configs, runs)
    by_hand = [x for x in subdirectories(spark, lake.path("filtered")) if "run_id=filter-" in x]
    if by_hand:  # keys that ``materialize_filter`` has stored
        known = spark.read.schema(TABLES["filtered"]).option("basePath", lake.path("filtered")).parquet(*by_hand)
        on = [*ALERT_KEY, "filter_config_hash"]
        found = found.join(known.select(*on), on, "left_anti")
    name = hashlib.md5(json.dumps(pairs).encode()).hexdigest()[:16]
    written = _store(found, lake, f"catalog-{name}")
    counts = {r[0]: r[1] for r in written.groupBy("filter_config_hash").count().collect()}
    lake.append_rows(spark, "materialized", [{"filter_config_hash": m, "run_id": r} for m, r in pairs])
    return {c.name: counts.get(c.config_hash(), 0) for c in configs}
