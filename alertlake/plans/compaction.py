"""Compaction of the alert table behind a manifest.

Runs leave a folder each. A compaction writes the folders that no compaction has taken yet into one,
dealt by ranges of (day, sky cell), and then replaces the manifest: from that file on readers take the
new folder instead of the runs in it, all at once. What it replaces is deleted by the next compaction,
when no reader of the old manifest should be left. ``merge_at`` folders become one. A run that is repeated
after its compaction is taken out of the folder by name. One writer at a time.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.functions import exprs as X
from alertlake.functions import sky
from alertlake.plans import storage

FILE_BYTES = 256 << 20
#: Smaller files than that, down to this size, are written where tasks would be fewer than the cores.
LEAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Compacted:
    """``folders``: name -> runs inside; ``void``: name -> runs that do not count any more."""

    version: int = 0
    folders: dict[str, list[str]] = None
    void: dict[str, list[str]] = None
    retired: tuple[str, ...] = ()

    @property
    def runs(self) -> set[str]:
        """Runs that readers take from the folders."""
        return {r for f, runs in (self.folders or {}).items() for r in runs if r not in (self.void or {}).get(f, ())}

    @property
    def file_name(self) -> str:
        return f"manifest-{self.version:010d}.json"


def manifest(spark: SparkSession, lake) -> Compacted:
    found = [x for x in storage.files_in(spark, lake.path("compacted")) if x.endswith(".json")]
    if not found:
        return Compacted(folders={}, void={})
    raw = json.loads(storage.read_text(spark, max(found)))
    return Compacted(**(raw | {"retired": tuple(raw["retired"])}))


def _save(spark: SparkSession, lake, old: Compacted, new: Compacted) -> None:
    made = replace(new, version=old.version + 1)
    top = lake.path("compacted")
    storage.write_text(spark, f"{top}/{made.file_name}", json.dumps(vars(made)))
    storage.drop_directory(spark, f"{top}/{replace(old, version=old.version - 1).file_name}")


def live_runs(spark: SparkSession, lake) -> list[str]:
    """Runs that have a folder of their own that counts."""
    taken = manifest(spark, lake).runs
    folders = storage.subdirectories(spark, lake.path("alerts"))
    return [r for r in (x.rsplit("run_id=", 1)[1] for x in folders) if r not in taken]


def stored_runs(spark: SparkSession, lake) -> list[str]:
    return sorted({*live_runs(spark, lake), *manifest(spark, lake).runs})


def forget_run(spark: SparkSession, lake, run_id: str) -> None:
    """Before a run is repeated: what compactions have of it does not count any more."""
    old = manifest(spark, lake)
    if run_id in old.runs:
        void = {f: sorted({*old.void.get(f, ()), run_id} & set(runs)) for f, runs in old.folders.items()}
        # Its old folder, if still there, goes now: the next compaction must not take the new one for it.
        path = lake.run_path("alerts", run_id)
        storage.drop_directory(spark, path)
        left = tuple(x for x in old.retired if x != path)
        _save(spark, lake, old, replace(old, void={f: v for f, v in void.items() if v}, retired=left))


def read_compacted(spark: SparkSession, lake, found: Compacted) -> DataFrame | None:
    parts = None
    for name, runs in sorted(found.folders.items()):
        rows = spark.read.schema(storage.TABLES["alerts"]).parquet(f"{lake.path('compacted')}/{name}")
        gone = found.void.get(name, [])
        rows = rows.where(~F.col("run_id").isin(gone)) if gone else rows
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def compact(spark: SparkSession, lake, pending: tuple[str, ...] = ()) -> int:
    """Compact the runs that have folders of their own, but for ``pending`` ones; how many these were."""
    old = manifest(spark, lake)
    top = lake.path("compacted")
    for path in old.retired:
        storage.drop_directory(spark, path)
    named = {*old.folders}
    for folder in storage.subdirectories(spark, top):  # of a compaction that broke off
        if folder.rsplit("/", 1)[1] not in named:
            storage.drop_directory(spark, folder)
    runs = [r for r in live_runs(spark, lake) if r not in pending]
    if not runs:
        return 0
    join = len(old.folders) + 1 >= lake.merge_at
    paths = [lake.run_path("alerts", r) for r in runs]
    kind = storage.TABLES["alerts"]
    rows = spark.read.schema(kind).option("basePath", lake.path("alerts")).parquet(*paths)
    earlier = read_compacted(spark, lake, old) if join else None
    rows = rows if earlier is None else rows.unionByName(earlier)
    replaced = [*paths, *(f"{top}/{f}" for f in old.folders if join)]
    size = sum(n for p in replaced for _, n, _ in storage.data_files(spark, p))
    name = uuid.uuid4().hex
    shared = min(2 * spark.sparkContext.defaultParallelism, math.ceil(size / LEAST_BYTES))
    _write(rows, f"{top}/{name}", max(shared, math.ceil(size / FILE_BYTES)), lake.partition_days)
    kept = {} if join else old.folders
    inside = sorted({*runs, *(old.runs if join else ())})
    void = {f: v for f, v in old.void.items() if f in kept}
    _save(spark, lake, old, Compacted(old.version, {**kept, name: inside}, void, tuple(replaced)))
    return len(runs)


def _write(rows: DataFrame, path: str, files: int, partition_days: int) -> None:
    place = ["mjd_day", sky.CELL, "dia_source_id", "mjd"]
    known = rows.withColumns(
        {"mjd_day": X.mjd_day("mjd", partition_days), sky.CELL: sky.sky_cell(F.col("ra"), F.col("dec"))}
    )
    dealt = known.repartitionByRange(max(1, files), *place).sortWithinPartitions(*place)
    dealt.write.partitionBy("mjd_day").parquet(path)
