"""Keys and states of the stored alerts: segments in hash buckets, behind a manifest.

Each run adds one segment, with the keys of its alerts and the state of its sources. A segment is cut
into buckets by hash of the alert id (keys) and of the source id (states); their number follows from its
rows, but a bucket is a folder with a file, and a segment has hundreds of them only where each is large. A batch opens the bucket folders that its own ids fall in, and no others. Segments of like size
are merged when enough of them are there, so that a table of n runs has some log(n) segments, and a key
is rewritten log(n) times.

The manifest names the live segments. It is replaced whole, under the next number: a reader sees the old
segments or the new ones. A run is noted as pending before its alerts are written, and taken out together
with its segment; the next run indexes what a broken one has left. The store is an index of the alert
table and can be rebuilt from it at any time. One run writes at a time.

A run may be repeated: its own segment is then left out. The newest run's segment is never merged
before another run begins, so this costs nothing; only a repetition of an older run, which has
been merged, builds the store anew from the alerts of the other runs.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.operators import state
from alertlake.plans import storage
from alertlake.plans.storage import TABLES, Lake
from alertlake.schema import ALERT_KEY, SOURCE_STATE_SCHEMA

#: Numbers that ids hash to; a segment has a power of two of buckets, this many at most.
HASHES = 4096
#: A segment of more buckets than this has as many as give each ``FULL_ROWS`` rows.
FOLDERS, FULL_ROWS = 256, 1_000_000

_KEYS = T.StructType([T.StructField(c, T.LongType()) for c in ALERT_KEY])
_PARTS = {"keys": (_KEYS, "alert_id"), "states": (SOURCE_STATE_SCHEMA, "dia_source_id")}


def hash_of(id_column: str) -> Column:
    return F.pmod(F.xxhash64(id_column), F.lit(HASHES)).cast("int")


def buckets_of(rows: int, bucket_rows: int) -> int:
    """Buckets of a segment: a power of two, for ``bucket_rows`` rows each as long as these are few folders."""
    wanted = max(1, math.ceil(rows / bucket_rows))
    wanted = min(wanted, max(FOLDERS, math.ceil(rows / FULL_ROWS)))
    return min(HASHES, 1 << (wanted - 1).bit_length())


@dataclass(frozen=True)
class Segment:
    name: str
    runs: tuple[str, ...]
    rows: int
    buckets: int


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    segments: tuple[Segment, ...] = ()
    pending: tuple[str, ...] = ()
    retired: tuple[str, ...] = ()  # no longer named; deleted when the next manifest is there

    @property
    def file_name(self) -> str:
        return f"manifest-{self.version:010d}.json"

    def text(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "segments": [vars(s) for s in self.segments],
                "pending": self.pending,
                "retired": self.retired,
            }
        )

    @staticmethod
    def parse(text: str) -> "Manifest":
        raw = json.loads(text)
        segments = tuple(Segment(**(s | {"runs": tuple(s["runs"])})) for s in raw["segments"])
        return Manifest(raw["version"], segments, tuple(raw["pending"]), tuple(raw["retired"]))


@dataclass
class Store:
    spark: SparkSession
    lake: Lake
    manifest: Manifest = field(default_factory=Manifest)
    gone: list[str] = field(default_factory=list)  # segments that the next manifest retires

    # --- reading ---

    @staticmethod
    def read(spark: SparkSession, lake: Lake) -> "Store | None":
        """The store as the newest manifest has it; None if the lake has none."""
        found = [x for x in storage.files_in(spark, lake.path("store")) if x.endswith(".json")]
        if not found:
            return None
        return Store(spark, lake, Manifest.parse(storage.read_text(spark, max(found))))

    def keys(self, hashes: Sequence[int] | None = None) -> DataFrame:
        """(alert_id, dia_source_id) of the stored alerts: all, or the buckets of these hashes."""
        return self._part("keys", self.manifest.segments, hashes)

    def states(self, hashes: Sequence[int] | None = None) -> DataFrame:
        """One row per source, merged from all segments: all, or the buckets of these hashes."""
        return state.merge_states(self._part("states", self.manifest.segments, hashes))

    def folders(self, part: str, segment: Segment, hashes: Sequence[int] | None) -> list[str]:
        """The bucket folders of a segment that ids of these hashes fall in."""
        top = f"{self.lake.path('store')}/{segment.name}/{part}"
        there = storage.subdirectories(self.spark, top)
        if hashes is None:
            return there
        wanted = {f"bucket={h % segment.buckets}" for h in hashes}
        return [x for x in there if x.rsplit("/", 1)[1] in wanted]

    def _part(self, part: str, segments: Sequence[Segment], hashes: Sequence[int] | None = None) -> DataFrame:
        schema, _ = _PARTS[part]
        paths = [x for s in segments for x in self.folders(part, s, hashes)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # --- writing ---

    @staticmethod
    def begin(spark: SparkSession, lake: Lake, run_id: str) -> "Store":
        """The store without ``run_id``, which is noted as pending. Settles what other runs left."""
        store = Store.read(spark, lake)
        if store is None:
            store = Store(spark, lake)
            if storage.exists(spark, lake.path("alerts")):  # written before there was a store
                store._rebuild(without=run_id)
        store._drop_unnamed()
        for other in store.manifest.pending:
            if other != run_id:
                store._add(other)
        own = [s for s in store.manifest.segments if run_id in s.runs]
        if any(len(s.runs) > 1 for s in own):
            store._rebuild(without=run_id)
        elif own:
            store._replace(own, ())
        store._merge()
        store._save(pending=(run_id,))
        return store

    def finish(self, run_id: str, track_state: bool = True) -> None:
        """Index the alerts that the run has written."""
        self._add(run_id, track_state)
        self._save(pending=())

    @staticmethod
    def rebuild(spark: SparkSession, lake: Lake) -> None:
        """Build the store anew from the alert table."""
        store = Store.read(spark, lake) or Store(spark, lake)
        store._rebuild()
        store._save(pending=())

    def _rebuild(self, without: str | None = None) -> None:
        rows = self.lake.read(self.spark, "alerts")
        if without is not None:
            rows = rows.where(F.col("run_id") != without)
        runs = tuple(sorted(r[0] for r in rows.select("run_id").distinct().collect()))
        made = self._write(runs, rows.count(), rows.select(*ALERT_KEY), state.source_state(rows))
        self._replace(self.manifest.segments, made)

    def _add(self, run_id: str, track_state: bool = True) -> None:
        path = self.lake.run_path("alerts", run_id)
        if not storage.exists(self.spark, path):
            return
        rows = self.spark.read.schema(TABLES["alerts"]).parquet(path)
        states = state.source_state(rows) if track_state else None
        self._replace((), self._write((run_id,), storage.count_rows(rows), rows.select(*ALERT_KEY), states))

    def _merge(self) -> None:
        """Join segments of like size while there are enough of them."""
        fan = self.lake.merge_at
        while True:
            by_size: dict[int, list[Segment]] = {}
            for s in self.manifest.segments:
                by_size.setdefault(int(math.log(max(1, s.rows), fan)), []).append(s)
            ready = next((x for _, x in sorted(by_size.items()) if len(x) >= fan), None)
            if ready is None:
                return
            runs = tuple(sorted({r for s in ready for r in s.runs}))
            states = state.merge_states(self._part("states", ready))
            rows = sum(s.rows for s in ready)
            self._replace(ready, self._write(runs, rows, self._part("keys", ready), states))

    def _write(self, runs: tuple, rows: int, keys: DataFrame, states: DataFrame | None) -> tuple[Segment, ...]:
        if not rows:
            return ()
        made = Segment(uuid.uuid4().hex, runs, rows, buckets_of(rows, self.lake.bucket_rows))
        for part, frame in (("keys", keys), ("states", states)):
            if frame is not None:
                schema, id_column = _PARTS[part]
                bucket = (hash_of(id_column) % made.buckets).alias("bucket")
                (
                    frame.select(*schema.fieldNames(), bucket)
                    .hint("rebalance", "bucket")
                    .sortWithinPartitions("bucket", id_column)
                    .write.partitionBy("bucket")
                    .parquet(f"{self.lake.path('store')}/{made.name}/{part}", compression="zstd")
                )
        return (made,)

    def _replace(self, old: Sequence[Segment], new: Sequence[Segment]) -> None:
        gone = {s.name for s in old}
        kept = tuple(s for s in self.manifest.segments if s.name not in gone)
        self.manifest = replace(self.manifest, segments=(*kept, *new))
        self.gone += sorted(gone)

    def _save(self, pending: tuple[str, ...]) -> None:
        """Write the next manifest, then delete what its predecessor had retired."""
        top, old = self.lake.path("store"), self.manifest
        self.manifest = Manifest(old.version + 1, old.segments, pending, tuple(self.gone))
        self.gone = []
        storage.write_text(self.spark, f"{top}/{self.manifest.file_name}", self.manifest.text())
        for name in old.retired:
            storage.drop_directory(self.spark, f"{top}/{name}")
        storage.drop_directory(self.spark, f"{top}/{replace(old, version=old.version - 1).file_name}")

    def _drop_unnamed(self) -> None:
        """Segments that a broken run wrote before it could name them."""
        named = {s.name for s in self.manifest.segments} | set(self.manifest.retired)
        for folder in storage.subdirectories(self.spark, self.lake.path("store")):
            if folder.rsplit("/", 1)[1] not in named:
                storage.drop_directory(self.spark, folder)
