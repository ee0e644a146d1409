"""Reassociation detection with state per source, carried across micro-batches and runs.

Sources are dealt to buckets by hash, and a bucket has one state with a row for each of its sources. The
rows of a bucket in a micro-batch come as Arrow batches and are compared as columns; the trigger's size
limit bounds them. State can begin with that of a stored table, and the row of a source goes when it has
been silent for so many days of its own time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from alertlake.operators.reassoc import CHANGED, NEW, UPDATED
from alertlake.schema import ARRIVAL_ORDER

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ID, _TIME, _AT = "ss_object_id", "ss_object_reassoc_time_mjd", "_observed_at"
_FLAGS = T.StructType(
    [
        T.StructField("is_reassociation", T.BooleanType()),
        T.StructField("reassociation_reason", T.StringType()),
        T.StructField("is_new_source", T.BooleanType()),
    ]
)
#: Sources are dealt to this many states by hash: a call for each, not for each source. Kept by a checkpoint.
BUCKETS = 1024
_BUCKET, _ORDER = "source_bucket", "arrival_order"  # rows reach pandas as named tuples: no leading _
_DAY_MS = 86_400_000
_EPOCH_MJD = 40587.0  # fixed value: 1970-01-01


class LastAssociation(StatefulProcessor):
    """State: association, time and ``mjd`` of the last row seen of each source of a bucket."""

    def __init__(self, columns: list[str], expire_days: float | None) -> None:
        self._columns, self._days = columns, expire_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        kind = "sources array<bigint>, ids array<string>, times array<double>, mjds array<double>"
        self._last = handle.getValueState("last", kind)

    def _known(self) -> pd.DataFrame:
        sources, ids, times, mjds = self._last.get() if self._last.exists() else ([], [], [], [])
        index = pd.Index(np.array(sources, dtype="int64"))
        known = {_ID: pd.Series(list(ids), index, dtype=object), _TIME: np.array(times, dtype=float)}
        return pd.DataFrame(known | {"mjd": np.array(mjds, dtype=float)}, index=index)

    def _keep(self, known: pd.DataFrame, seen: pd.DataFrame, watermark: int | None) -> None:
        """Rows of ``seen`` replace those of ``known``; silent sources go once the watermark has passed."""
        every = pd.concat([known[~known.index.isin(seen.index)], seen]) if len(known) else seen
        if self._days is not None:
            ends = (every["mjd"] - _EPOCH_MJD + self._days) * _DAY_MS
            left = ~(ends < watermark)
            every, ends = every[left], ends[left].min()
            # The next whole day: a bucket is looked through once a day at most.
            if not pd.isna(ends):
                self._handle.registerTimer((int(ends) // _DAY_MS + 1) * _DAY_MS)
        if not len(every):
            self._last.clear()
            return
        ids = every[_ID].astype(object).where(every[_ID].notna(), None)
        self._last.update((every.index.tolist(), ids.tolist(), every[_TIME].tolist(), every["mjd"].tolist()))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        rows = initialState.drop_duplicates("dia_source_id", keep="last")
        given = {"ss_object_reassoc_time": _TIME, "last_seen_mjd": "mjd"}
        self._keep(self._known(), _by_source(rows.rename(columns=given)), timerValues.getCurrentWatermarkInMs())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows), ignore_index=True)
        found = found.sort_values(["dia_source_id", "mjd", _ORDER], ignore_index=True)
        known, now = self._known(), _by_source(found)
        sources = now.index.to_numpy()
        first = np.append(True, sources[1:] != sources[:-1])
        now = now.reset_index(drop=True)
        before = known.reindex(sources[first])
        last = now.shift(1)
        for c in last.columns:
            last.loc[first, c] = before[c].to_numpy()
        ident, time, mjd = now[_ID], now[_TIME], now["mjd"]
        last_id = last[_ID].astype(object).where(last[_ID].notna(), None)
        last_time, last_mjd = last[_TIME].astype(float), last["mjd"].astype(float)

        fresh = last_mjd.isna()
        if self._days is not None:
            fresh |= mjd - last_mjd > self._days
        changed = ident.notna() & (last_id != ident)
        moved = last_time.notna() & time.notna() & (last_time != time)
        reason = np.select([fresh, changed & last_id.isna(), changed, moved], ["", NEW, CHANGED, UPDATED], "")
        made = found[self._columns].copy()
        made["is_reassociation"] = reason != ""
        made["reassociation_reason"] = pd.Series(reason, dtype=object).where(reason != "", None)
        made["is_new_source"] = fresh.to_numpy()
        end = np.append(first[1:], True)
        self._keep(known, now[end].set_axis(sources[end]), timerValues.getCurrentWatermarkInMs())
        yield made

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._last.exists():
            known = self._known()
            self._keep(known, known.iloc[:0], timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame(columns=[*self._columns, *_FLAGS.fieldNames()])

    def close(self) -> None:
        pass


def _by_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Association, time and ``mjd`` by source. Rows without a source are alone in their bucket."""
    index = rows["dia_source_id"].fillna(0).astype("int64").to_numpy()
    ident = rows[_ID].astype(object).where(rows[_ID].notna(), None).to_numpy()
    found = {_TIME: rows[_TIME].astype(float).to_numpy(), "mjd": rows["mjd"].astype(float).to_numpy()}
    return pd.DataFrame({_ID: pd.Series(ident, dtype=object)} | found).set_axis(index)


def _dealt(rows: DataFrame) -> DataFrame:
    source = F.col("dia_source_id")
    return rows.withColumn(_BUCKET, F.when(source.isNull(), -1).otherwise(F.pmod(F.xxhash64(source), F.lit(BUCKETS))).cast("int"))


def detect_in_stream(
    alerts: DataFrame,
    *,
    expire_days: float | None = None,
    late: str = "0 seconds",
    prior_state: DataFrame | None = None,
) -> DataFrame:
    """Streaming counterpart of ``detect_reassociations`` for deduplicated alerts.

    Within a micro-batch rows count as arrived in (mjd, alert_id) order; across batches a
    row is compared with the latest seen before it. ``prior_state`` (one row per source, as
    ``source_state`` makes it) is where a new query begins; a query that goes on has its own.

    ``expire_days`` (the usual value is 90): a source counts as new again if its last row is
    longer ago, by ``mjd``. Its state goes when the watermark, ``late`` behind the newest ``mjd``,
    has passed that time; rows older than the watermark are not taken.
    """
    if alerts.sparkSession.conf.get(PROVIDER, None) != ROCKSDB:
        raise ValueError(f"set {PROVIDER} to {ROCKSDB}: state with timers needs it")
    # Spark starts a worker of its own for the processor, which may not find this package: send its code.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    plain = alerts.drop("is_reassociation", "reassociation_reason", "is_new_source")
    # pandas has no long with nulls, so whole numbers travel as text.
    whole = [f.name for f in plain.schema.fields if isinstance(f.dataType, T.IntegralType) and f.name != "dia_source_id"]
    order = F.coalesce(F.col(ARRIVAL_ORDER[1]).cast("long"), F.lit(2**63 - 1))
    sent = plain.withColumns({_ORDER: order} | {c: F.col(c).cast("string") for c in whole})
    timed = sent
    if expire_days is not None:
        at = F.timestamp_micros(((F.col("mjd") - _EPOCH_MJD) * (_DAY_MS * 1000)).cast("long"))
        timed = sent.withColumn(_AT, at).withWatermark(_AT, late)
    if prior_state is not None:
        prior = prior_state.select("dia_source_id", _ID, "ss_object_reassoc_time", "last_seen_mjd")
        prior_state = _dealt(prior).groupBy(_BUCKET)
    out = _dealt(timed).groupBy(_BUCKET).transformWithStateInPandas(
        statefulProcessor=LastAssociation(plain.columns, expire_days),
        outputStructType=T.StructType([*sent.select(*plain.columns).schema.fields, *_FLAGS.fields]),
        outputMode="Append",
        timeMode="EventTime" if expire_days is not None else "None",
        initialState=prior_state,
    )
    return out.withColumns({c: F.col(c).cast(plain.schema[c].dataType) for c in whole})
