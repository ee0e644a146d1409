"""Pluggable analyses over a time window of the alert table."""

from __future__ import annotations

import itertools
import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.functions import exprs as X
from alertlake.operators import aggregates
from alertlake.operators.filters import prune_days
from alertlake.plans import storage
from alertlake.plans.storage import Lake
from alertlake.schema import PROCESSOR_RUN_SCHEMA


class Processor:
    """``transform`` maps the window's alerts to a result DataFrame; nothing runs in it."""

    name = "processor"
    version = "1.0.0"
    description = ""
    default_window_days = 15
    min_alerts = 1

    def __init__(self, **params: Any) -> None:
        self.params = params

    def select(self) -> Column | None:
        """Extra row predicate, pushed into the scan of the window."""
        return None

    def pre_process(self, alerts: DataFrame) -> DataFrame:
        return alerts

    def transform(self, alerts: DataFrame) -> DataFrame:
        raise NotImplementedError

    def post_process(self, result: DataFrame) -> DataFrame:
        return result

    def metadata(self) -> dict[str, Any]:
        return {}

    def summary(self, records: int, input_rows: int) -> str:
        return f"{records} records from {input_rows} alerts"

    def input(self, alerts: DataFrame, start_mjd: float, end_mjd: float) -> DataFrame:
        window = prune_days(alerts, start_mjd, end_mjd)
        test = self.select()
        return window if test is None else window.where(test)

    def output(self, rows: DataFrame) -> DataFrame:
        return self.post_process(self.transform(self.pre_process(rows)))

    def run(self, alerts: DataFrame, start_mjd: float, end_mjd: float) -> DataFrame:
        """Lazy result over a window."""
        return self.output(self.input(alerts, start_mjd, end_mjd))


class RowProcessor(Processor):
    """Keeps the rows that meet ``condition``."""

    def condition(self) -> Column:
        raise NotImplementedError

    def transform(self, alerts: DataFrame) -> DataFrame:
        return alerts.where(self.condition())


class GroupProcessor(Processor):
    """One record per group. Either Spark aggregates (``columns``), or a Python function.

    Python works on mergeable state, so that no group is ever in one call: ``partial`` condenses
    the rows of a group in one Arrow batch to a few rows of state, ``merge`` makes one state of
    several, and ``combine`` makes the record of the merged states. A group has at most a state
    for each task to combine, however many rows it has, and a single one unless it is large.
    """

    group_by = "dia_object_id"
    result_schema: T.StructType | str = ""
    partial_schema: T.StructType | str = ""

    def columns(self) -> list[Column] | None:
        return None

    def having(self) -> Column | None:
        return None

    partial: Callable[[Any, pd.DataFrame], pd.DataFrame] | None = None
    merge: Callable[[Any, pd.DataFrame], pd.DataFrame] | None = None
    combine: Callable[[Any, pd.DataFrame], dict | None] | None = None

    def transform(self, alerts: DataFrame) -> DataFrame:
        key = self.group_by
        rows = alerts.where(F.col(key).isNotNull())
        columns = self.columns()
        if columns is not None:
            out = rows.groupBy(key).agg(*columns)
            test = self.having()
            return out if test is None else out.where(test)
        if None not in (self.partial, self.merge, self.combine):
            return self._merged_states(rows)
        raise NotImplementedError("give columns(), or partial, merge and combine")

    def _records(self) -> Callable:
        names = T.StructType.fromDDL(self.result_schema).fieldNames() if isinstance(
            self.result_schema, str
        ) else self.result_schema.fieldNames()
        key, combine = self.group_by, self.combine

        def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """A record for each key of sorted states; the last key of a batch waits for the next one."""
            rest = None
            for batch in itertools.chain(batches, [None]):
                parts = [x for x in (rest, batch) if x is not None and len(x)]
                if not parts:
                    continue
                states = pd.concat(parts, ignore_index=True)
                ends = (states[key] == states[key].iloc[-1]) & (batch is not None)
                rest, whole = states[ends], states[~ends]
                made = [combine(k, group) for k, group in whole.groupby(key)]
                found = pd.DataFrame([x for x in made if x is not None], columns=names, dtype=object)
                for name in names:  # whole numbers beside a null stay objects, not floats
                    if not pd.api.types.is_integer_dtype(found[name].dropna().infer_objects()) or found[name].notna().all():
                        found[name] = found[name].infer_objects()
                yield found

        return records

    def _merged_states(self, rows: DataFrame) -> DataFrame:
        key, partial, merge = self.group_by, self.partial, self.merge

        def condense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            open_key, state = None, None  # the last key seen may go on in the next batch
            for batch in batches:
                done = []
                for k, group in batch.groupby(key):
                    found = partial(k, group)
                    if state is not None and k == open_key:
                        state = merge(k, pd.concat([state, found], ignore_index=True))
                        continue
                    if state is not None:
                        done.append(state)
                    open_key, state = k, found
                if done:
                    yield pd.concat(done, ignore_index=True)
            if state is not None:
                yield state

        # Ranges of rows: a key is in one place, so that ``partial`` is called once for it, and only
        # a key that is longer than a range is cut; batches are streamed, no group is held. The calls
        # cost more than the bytes, so the number of tasks is given instead of joined by size.
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.repartitionByRange(tasks, F.col(key), F.monotonically_increasing_id())
        states = dealt.sortWithinPartitions(key).mapInPandas(condense, self.partial_schema)
        gathered = states.repartition(tasks, key).sortWithinPartitions(key)
        return gathered.mapInPandas(self._records(), self.result_schema)


# --- registry -----------------------------------------------------------------------------

_REGISTRY: dict[str, type[Processor]] = {}


def register(cls: type[Processor]) -> type[Processor]:
    _REGISTRY[cls.name] = cls
    return cls


def unregister(name: str) -> bool:
    return _REGISTRY.pop(name, None) is not None


def get(name: str) -> type[Processor] | None:
    return _REGISTRY.get(name)


def info() -> list[dict[str, Any]]:
    return [
        {
            "name": c.name,
            "version": c.version,
            "description": c.description,
            "default_window_days": c.default_window_days,
        }
        for _, c in sorted(_REGISTRY.items())
    ]


# --- built-ins ----------------------------------------------------------------------------


@register
class AlertStatistics(Processor):
    name = "example"
    description = "Basic statistics of the window"
    default_window_days = 7

    def transform(self, alerts: DataFrame) -> DataFrame:
        return aggregates.alert_stats(alerts)


@register
class MinimoonCandidates(RowProcessor):
    name = "minimoon_candidates"
    description = "Solar-system alerts of intermediate extendedness and sufficient SNR"
    min_snr = 5.0

    def select(self) -> Column:
        return F.col("has_ss_source")

    def condition(self) -> Column:
        bright = F.col("snr").isNull() | (F.col("snr") >= self.min_snr)
        return F.col("extendedness_median").between(X.POINT_MAX, X.EXTENDED_MIN) & bright

    def post_process(self, result: DataFrame) -> DataFrame:
        return result.orderBy("mjd", "alert_id", "dia_source_id")

    def metadata(self) -> dict[str, Any]:
        return {"where": [str(self.select()), str(self.condition())]}


@register
class SourceSummary(Processor):
    name = "source_summary"
    description = "Per-object summaries of at least two detections"
    default_window_days = 30

    def transform(self, alerts: DataFrame) -> DataFrame:
        return aggregates.source_summary(alerts)


@register
class ReassociationTracker(Processor):
    name = "reassociation_tracker"
    description = "Sources whose solar-system association was made or changed"
    default_window_days = 30

    def select(self) -> Column:
        return F.col("is_reassociation")

    def transform(self, alerts: DataFrame) -> DataFrame:
        return aggregates.reassociation_tracker(alerts)


# --- running --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Outcome:
    """What became of one processor: its row of the run log, and the folder of its results."""

    row: dict[str, Any]
    path: str | None = None

    @property
    def status(self) -> str:
        """completed, failed, or skipped for want of alerts."""
        return self.row["status"]


class Runner:
    """Runs processors over the newest window and keeps their results in typed tables."""

    def __init__(self, alerts: DataFrame, lake: Lake) -> None:
        self.alerts, self.lake = alerts, lake

    def run(
        self,
        name: str,
        *,
        window_days: float | None = None,
        as_of: datetime | None = None,
        save: bool = True,
        source: DataFrame | None = None,
        **params: Any,
    ) -> Outcome:
        """Never raises: what goes wrong is in the outcome. Skipped and empty runs are not logged."""
        clock, path = time.monotonic(), None
        row = dict.fromkeys(PROCESSOR_RUN_SCHEMA.fieldNames()) | {
            "run_id": uuid.uuid4().hex,
            "processor_name": name,
            "record_count": 0,
            "input_rows": 0,
            "status": "completed",
        }
        about: dict[str, Any] = {}
        try:
            processor = _REGISTRY[name](**params)
            days = processor.default_window_days if window_days is None else window_days
            end = X.as_of_mjd(as_of)
            row |= {
                "processor_version": processor.version,
                "window_start_mjd": end - days,
                "window_end_mjd": end,
            }
            rows = processor.input(self.alerts if source is None else source, end - days, end)
            # Counts come from finished tables, not from metrics of running tasks, which
            # count twice when tasks are repeated.
            row["input_rows"] = storage.count_rows(rows)
            if row["input_rows"] < processor.min_alerts:
                row["status"] = "skipped"
                row["summary"] = f"{processor.min_alerts} alerts wanted, {row['input_rows']} there"
            else:
                path, row["record_count"] = self._keep(processor, rows, row["run_id"], save)
                row["summary"] = processor.summary(row["record_count"], row["input_rows"])
                about = processor.metadata()
        except KeyError as err:
            row |= {"status": "failed", "error_message": f"no entry {err}"}
        except Exception as err:
            row |= {"status": "failed", "error_message": str(err)}
        row |= {
            "elapsed_seconds": time.monotonic() - clock,
            "processed_at": datetime.now(timezone.utc),
            "metadata": json.dumps(about, sort_keys=True),
        }
        if save and (row["record_count"] or row["status"] == "failed"):
            self.lake.append_row(self.alerts.sparkSession, "processor_runs", row)
        return Outcome(row, path)

    def _keep(
        self, processor: Processor, rows: DataFrame, run_id: str, save: bool
    ) -> tuple[str | None, int]:
        """Where the results are, if they are kept, and how many there are."""
        result = processor.output(rows)
        if not save:
            return None, storage.count_rows(result)
        path = self.lake.run_path(f"results/{processor.name}", run_id)
        result.write.mode("overwrite").parquet(path)
        return path, storage.count_rows(rows.sparkSession.read.schema(result.schema).parquet(path))

    def run_all(
        self,
        names: Iterable[str] | None = None,
        *,
        window_days: float = 15,
        as_of: datetime | None = None,
        save: bool = True,
        stop_on_error: bool = False,
    ) -> list[Outcome]:
        """All (or the named) processors over one window; each pushes its own predicate into the scan."""
        outcomes: list[Outcome] = []
        for name in names if names is not None else sorted(_REGISTRY):
            outcomes.append(self.run(name, window_days=window_days, as_of=as_of, save=save))
            if stop_on_error and outcomes[-1].status == "failed":
                break
        return outcomes
