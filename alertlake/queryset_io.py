"""Second part of the registered queries: readers, processors, ingest, streams, sinks, stamps."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.fixture import AS_OF, Tables, with_ctes
from alertlake.functions import exprs as X
from alertlake.operators import cutouts as C
from alertlake.operators import presets as P
from alertlake.operators import reassoc as R
from alertlake.operators import state as ST
from alertlake.operators import views as VW
from alertlake.plans import catalog as CT
from alertlake.plans import export as E
from alertlake.plans import ingest as I
from alertlake.plans import processors as PR
from alertlake.plans import reports as RP
from alertlake.plans import storage as SG
from alertlake.queryset import AS_OF_TIME, MOON, ROW, ROW_SQL, add, near, r6, rows
from alertlake.schema import ALERT_COLUMNS, LOCUS_SCHEMA, PACKET_SCHEMA
from alertlake.session import scratch_path
from alertlake.sources import files as FS
from alertlake.sources import locus as L
from alertlake.sources import orbits as O
from alertlake.sources import packets as PK
from alertlake.sources import portal as PO
from alertlake.sources import wire as W
from alertlake.streaming import ingest as SI
from alertlake.streaming import reassoc as SR


WIDTH = 60  # days per partition: the benchmark rows spread thinly over years


def _delivered(t: Tables, rows: DataFrame, label: str) -> DataFrame:
    """Rows as a stored table: several runs over them do not derive them several times."""
    folder = scratch_path(t.spark, label)
    rows.write.parquet(folder)
    return t.spark.read.schema(rows.schema).parquet(folder)


def _map_text(name: str, number: bool) -> F.Column:
    value = (lambda v: F.floor(v).cast("string")) if number else (lambda v: v.cast("string"))
    return F.array_join(
        F.transform(F.map_entries(name), lambda e: F.concat(e["key"], F.lit("="), value(e["value"]))),
        ",",
    )


def _flat(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        *ROW,
        "extendedness_max",
        "ss_object_reassoc_time_mjd",
        _map_text("trail_data", True).alias("trail_text"),
        _map_text("pixel_flags", False).alias("flag_text"),
    )


_TRAIL_SQL = """concat_ws(',',
 CASE WHEN l_linenumber % 2 = 0 THEN 'trailLength=' || CAST(floor(l_quantity) AS BIGINT) END,
 CASE WHEN l_returnflag = 'R' THEN 'trailAngle=' || (l_partkey % 360) END) AS trail_text"""
_FLAG_SQL = """concat_ws(',', 'pixelFlagsBad=' || (l_suppkey % 2 = 0),
 CASE WHEN l_linenumber % 2 = 0 THEN 'pixelFlagsCr=' || (l_partkey % 3 = 0) END,
 'pixelFlagsSaturated=false') AS flag_text"""

add(
    "flatten_packet",
    lambda t: _flat(PK.flatten_packet(t.packets)),
    with_ctes(
        "fx",
        f"""SELECT {ROW_SQL}, extendedness_max, ss_object_reassoc_time_mjd,
        {_TRAIL_SQL}, {_FLAG_SQL} FROM fx""",
    ),
)


# --- framed messages -------------------------------------------------------------------------


def _framed(t: Tables) -> DataFrame:
    """Line 5 is broken JSON; even parts carry schema id 8, whose packets know no ssObject."""
    number = F.when(F.col("diaSource.diaSourceId") % 2 == 0, F.lit("00000008")).otherwise(
        F.lit("00000007")
    )
    body = F.to_json(F.struct("alertId", "diaSource", "ssObject"))
    broken = F.when(F.col("alertId") % 8 == 5, F.lit('{"alertId": 1, "dia')).otherwise(body)
    header = F.unhex(F.concat(F.lit("00"), number))
    return t.packets.select(F.concat(header, broken.cast("binary")).alias("value"))


def _decode(t: Tables) -> tuple[DataFrame, DataFrame]:
    narrow = PACKET_SCHEMA.__class__([x for x in PACKET_SCHEMA.fields if x.name != "ssObject"])
    return W.decode_messages(_framed(t), by_schema_id={8: narrow})


add(
    "wire_header",
    lambda t: W.split_header(
        t.fx.select(
            "alert_id",
            F.when(
                F.col("l_linenumber") % 3 == 0,
                F.concat(
                    F.lit(b"\0"),
                    F.unhex(F.lpad(F.hex("l_partkey"), 8, "0")),
                    F.concat(F.lit("body"), F.col("l_suppkey").cast("string")).cast("binary"),
                ),
            )
            .when(F.col("l_linenumber") % 3 == 1, F.lit(b"\1plain body"))
            .otherwise(F.lit(b"\0abc"))
            .alias("value"),
        )
    ).select("alert_id", "schema_id", F.hex("payload").alias("payload")),
    with_ctes(
        "fx",
        """SELECT alert_id, CASE WHEN l_linenumber % 3 = 0 THEN l_partkey END AS schema_id,
        CASE WHEN l_linenumber % 3 = 0 THEN hex('body' || l_suppkey) WHEN l_linenumber % 3 = 1
        THEN '01' || hex('plain body') ELSE '00' || hex('abc') END AS payload FROM fx""",
    ),
)
_KNOWN_SSO = "(has_ss_source AND dia_source_id % 2 <> 0)"
add(
    "decode_messages",
    lambda t: _flat(_decode(t)[0]),
    with_ctes(
        "fx",
        f"""SELECT * REPLACE ({_KNOWN_SSO} AS has_ss_source,
        CASE WHEN {_KNOWN_SSO} THEN ss_object_id END AS ss_object_id,
        CASE WHEN {_KNOWN_SSO} THEN ss_object_reassoc_time_mjd END AS ss_object_reassoc_time_mjd)
        FROM (SELECT {ROW_SQL}, extendedness_max, ss_object_reassoc_time_mjd,
        {_TRAIL_SQL}, {_FLAG_SQL} FROM fx WHERE l_linenumber <> 5)""",
    ),
)
add(
    "decode_failures",
    lambda t: _decode(t)[1].groupBy("schema_id").agg(F.count(F.lit(1)).alias("n")),
    with_ctes(
        "fx",
        """SELECT CASE WHEN dia_source_id % 2 = 0 THEN 8 ELSE 7 END AS schema_id, count(*) AS n
        FROM fx WHERE l_linenumber = 5 GROUP BY 1""",
    ),
)


# --- portal rows, loci, orbits ---------------------------------------------------------------

def _portal_alerts(t: Tables) -> DataFrame:
    """Written as JSON lines and read back by the portal reader."""
    folder = scratch_path(t.spark, "portal")
    t.portal_json.write.text(folder)
    return PO.read_portal_json(t.spark, folder, multi_line=False)


add(
    "portal_mapping",
    lambda t: _portal_alerts(t).select(
        "alert_id",
        "dia_source_id",
        "dia_object_id",
        "ra",
        "dec",
        "mjd",
        "filter_name",
        F.round(F.col("ps_flux") * 1e9 + 3.1e-7, 4).alias("flux_nano"),
        F.round(F.col("ps_flux_err") * 1e9 + 3.1e-7, 4).alias("flux_err_nano"),
        r6("snr").alias("snr"),
        r6("extendedness_median").alias("ext"),
        (F.col("extendedness_min") == F.col("extendedness_max")).alias("same"),
        "has_ss_source",
        "ss_object_id",
    ),
    with_ctes(
        "fx",
        """SELECT alert_id, alert_id AS dia_source_id,
        CAST('0x' || substr(md5('OBJ' || l_partkey), 1, 15) AS BIGINT) AS dia_object_id,
        ra, dec, mjd, CASE l_linenumber WHEN 1 THEN 'g' WHEN 2 THEN 'r' WHEN 3 THEN 'i'
        ELSE 'unknown' END AS filter_name,
        round(flux * 1e9 + 3.1e-7, 4) AS flux_nano,
        CASE WHEN l_discount > 0 THEN
          round(0.4 * ln(10) * flux * l_discount * 1e9 + 3.1e-7, 4) END AS flux_err_nano,
        CASE WHEN l_discount > 0 THEN round(1 / l_discount + 3.1e-9, 6) END AS snr,
        round(1 - extendedness_median + 3.1e-9, 6) AS ext,
        CASE WHEN extendedness_median IS NOT NULL THEN true END AS same,
        l_returnflag = 'R' AS has_ss_source,
        coalesce(CASE WHEN l_returnflag <> 'R' THEN ss_object_id END,
          CASE WHEN l_linenumber % 2 = 0 THEN 'named' END) AS ss_object_id
        FROM (SELECT *, CASE WHEN l_tax < 0.08 THEN pow(10, -0.4 * (l_quantity / 10 + 15)) END
        AS flux FROM fx WHERE l_linenumber < 7 OR l_tax < 0.08)""",
    ),
)

def _loci(t: Tables) -> DataFrame:
    """The loci as a stored table, as a broker delivers them."""
    folder = scratch_path(t.spark, "loci")
    t.loci.write.parquet(folder)
    return t.spark.read.schema(LOCUS_SCHEMA).parquet(folder)


_LOCUS_STEPS = """steps AS (SELECT *, mjd + i / 4 AS seen_at, l_partkey % 3 AS known
 FROM (SELECT *, CAST(unnest({I}) AS DOUBLE) AS i FROM fx WHERE l_linenumber > 1)),
 named AS (SELECT *, known < 2 AND ss_object_id IS NOT NULL AS has_id FROM steps),
 loci AS (SELECT *, has_id OR l_suppkey % 4 < 2 AS sso,
 CASE WHEN has_id THEN ss_object_reassoc_time_mjd END AS time,
 CASE WHEN i % 3 <> 0 THEN seen_at + 0.5 END AS own_mjd, seen_at AS alert_mjd FROM named)"""
_LOCUS_SELECT = """SELECT alert_id * 8 + CAST(i AS BIGINT) AS alert_id, dia_source_id,
 dia_object_id, CASE WHEN i % 2 = 0 THEN ra ELSE ra / 2 END AS ra,
 CASE WHEN i % 2 = 0 THEN dec ELSE dec / 2 END AS dec, coalesce(own_mjd, alert_mjd) AS mjd,
 filter_name, snr, extendedness_median, sso AS has_ss_source,
 CASE WHEN has_id THEN ss_object_id END AS ss_object_id,
 coalesce(abs(time - coalesce(own_mjd, alert_mjd)) <= 1, false) AS is_reassociation,
 CASE WHEN abs(time - coalesce(own_mjd, alert_mjd)) <= 1 THEN
  printf('Recent SSObject reassociation (dt=%.3f days)', abs(time - coalesce(own_mjd, alert_mjd)))
 END AS reassociation_reason FROM loci"""
_LOCUS_COLS = (*ROW, "is_reassociation", "reassociation_reason")


def _locus_sql(series: str, select: str) -> str:
    base = with_ctes("fx", "")
    return f"{base.strip()}, {_LOCUS_STEPS.format(I=series)} {select}"


_LAST_ONE = "[l_linenumber - 1]"
_ALL = "generate_series(1, l_linenumber - 1)"
add(
    "locus_latest",
    lambda t: L.locus_latest(_loci(t)).select(*_LOCUS_COLS),
    _locus_sql(_LAST_ONE, _LOCUS_SELECT),
)
add(
    "locus_history",
    lambda t: L.locus_history(_loci(t)).select(*_LOCUS_COLS),
    _locus_sql(_ALL, _LOCUS_SELECT),
)
add(
    "sso_association",
    lambda t: L.locus_history(_loci(t))
    .groupBy("has_ss_source", "ss_object_id")
    .agg(
        F.count(F.lit(1)).alias("n"),
        F.count("ss_object_reassoc_time_mjd").alias("timed"),
    ),
    _locus_sql(
        _ALL,
        """SELECT sso AS has_ss_source, CASE WHEN has_id THEN ss_object_id END AS ss_object_id,
        count(*) AS n, count(time) AS timed FROM loci GROUP BY 1, 2""",
    ),
)
_LOCUS_PASS = """SELECT CAST(alert_id AS VARCHAR) AS locus_id FROM loci
 WHERE extendedness_median IS NOT NULL AND (has_id OR l_suppkey % 4 = 1)
 AND (({IN}) {NEAR})"""
_IN = (
    "extendedness_median BETWEEN 0.2 AND 0.8 AND extendedness_min >= 0.25 "
    "AND extendedness_max <= 0.95"
)
_PF = dict(median_low=0.2, median_high=0.8, min_low=0.25, max_high=0.95)
add(
    "locus_pass_filter_v2",
    lambda t: R.PassFilter(**_PF).on_loci(_loci(t)).select("locus_id"),
    _locus_sql(
        _LAST_ONE,
        _LOCUS_PASS.format(IN=_IN, NEAR="OR coalesce(abs(time - own_mjd) <= 1, false)"),
    ),
)
add(
    "locus_pass_filter_v1",
    lambda t: R.PassFilter(**_PF, reassociation=False).on_loci(_loci(t)).select("locus_id"),
    _locus_sql(_LAST_ONE, _LOCUS_PASS.format(IN=_IN, NEAR="")),
)
add(
    "orbit_alerts",
    lambda t: O.orbits_to_alerts(
        t.table("part").select(
            F.concat_ws("-", "p_name", "p_partkey").alias("name"),
            F.col("p_size").cast("double").alias("a"),
            (F.col("p_size") * 5).cast("double").alias("inc"),
            (F.col("p_retailprice") - 1200).alias("node"),
            (F.lit(2460000.5) + F.col("p_size")).alias("epoch_jd"),
        )
    ).select(
        "alert_id",
        "dia_source_id",
        r6("ra").alias("ra"),
        "dec",
        "mjd",
        "has_ss_source",
        "ss_object_id",
        "extendedness_median",
        F.col("orbit.inc").alias("inc"),
    ),
    """SELECT id AS alert_id, CAST(CASE WHEN low >= 9223372036854775808 THEN
      low - 18446744073709551616 ELSE low END AS BIGINT) AS dia_source_id,
     round(CASE WHEN node % 360 < 0 THEN node % 360 + 360 ELSE node % 360 END + 3.1e-9, 6) AS ra,
     greatest(-90, least(90, inc - 90)) AS dec, 60000.0 + p_size AS mjd, true AS has_ss_source,
     name AS ss_object_id, CAST(0.1 AS DOUBLE) AS extendedness_median, inc
    FROM (SELECT *, (CAST(id AS HUGEINT) * 1000) % 18446744073709551616 AS low FROM (
      SELECT p_name || '-' || p_partkey AS name, p_size,
      CAST('0x' || substr(md5(p_name || '-' || p_partkey), 1, 15) AS BIGINT) AS id,
      p_retailprice - 1200 AS node, CAST(p_size * 5 AS DOUBLE) AS inc FROM part))""",
)


# --- processors --------------------------------------------------------------------------------

_END = X.as_of_mjd(AS_OF_TIME)
_START = _END - 700
_WIN = f"mjd >= {_START!r} AND mjd <= {_END!r}"
rows(
    "processor_minimoon",
    lambda t: PR.MinimoonCandidates().run(t.alerts, _START, _END),
    f"WHERE {_WIN} AND {MOON} AND (snr IS NULL OR snr >= 5)",
)


class SnrByObject(PR.GroupProcessor):
    """Mean SNR per object in Python, in two steps."""

    name = "snr_by_object"
    partial_schema = "dia_object_id long, n long, total double"
    result_schema = "dia_object_id long, n long, mean_snr double"

    @staticmethod
    def partial(key, group):
        return pd.DataFrame(
            {"dia_object_id": [key], "n": [len(group)], "total": [group["snr"].sum()]}
        )

    @staticmethod
    def merge(key, parts):
        return pd.DataFrame(
            {"dia_object_id": [key], "n": [parts["n"].sum()], "total": [parts["total"].sum()]}
        )

    @staticmethod
    def combine(key, parts):
        n = int(parts["n"].sum())
        if n < 2:
            return None
        return {"dia_object_id": key, "n": n, "mean_snr": float(parts["total"].sum() / n)}


class SpanByObject(PR.GroupProcessor):
    """Observed span per object, in Spark aggregates: no object is held whole."""

    name = "span_by_object"

    def columns(self):
        span = F.max("mjd") - F.min("mjd")
        return [F.count(F.lit(1)).alias("n"), span.alias("span")]

    def having(self):
        return F.col("n") > 1


add(
    "processor_python_two_step",
    lambda t: SnrByObject()
    .run(t.alerts.select("dia_object_id", "mjd", "snr"), _START, _END)
    .withColumn("mean_snr", r6("mean_snr")),
    with_ctes(
        "alerts",
        f"""SELECT dia_object_id, count(*) AS n, round(avg(snr) + 3.1e-9, 6) AS mean_snr
        FROM alerts WHERE {_WIN} AND dia_object_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 2""",
    ),
)
add(
    "processor_python_hot_key",
    lambda t: SnrByObject()
    .run(
        t.alerts.select(
            F.when(F.col("alert_id") % 3 == 0, F.lit(7)).otherwise(F.col("dia_object_id")).alias("dia_object_id"),
            "mjd",
            "snr",
        ),
        _START,
        _END,
    )
    .withColumn("mean_snr", r6("mean_snr")),
    with_ctes(
        "alerts",
        f"""SELECT dia_object_id, count(*) AS n, round(avg(snr) + 3.1e-9, 6) AS mean_snr FROM (
        SELECT * REPLACE (CASE WHEN alert_id % 3 = 0 THEN 7 ELSE dia_object_id END AS dia_object_id) FROM alerts)
        WHERE {_WIN} AND dia_object_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 2""",
    ),
)
add(
    "processor_python_group",
    lambda t: SpanByObject().run(t.alerts.select("dia_object_id", "mjd"), _START, _END),
    with_ctes(
        "alerts",
        f"""SELECT dia_object_id, count(*) AS n, max(mjd) - min(mjd) AS span
        FROM alerts WHERE {_WIN} AND dia_object_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 2""",
    ),
)


def _run_all(t: Tables) -> DataFrame:
    lake = SG.Lake(scratch_path(t.spark, "processors"))
    names = ["example", "minimoon_candidates", "reassociation_tracker", "source_summary"]
    PR.Runner(_delivered(t, t.flagged, "flagged"), lake).run_all(names, window_days=700, as_of=AS_OF_TIME)
    return lake.read(t.spark, "processor_runs").select(
        "processor_name", "record_count", "input_rows", "status"
    )


add(
    "processors_run_all",
    _run_all,
    with_ctes(
        "flagged",
        f""", w AS (SELECT * FROM flagged WHERE {_WIN})
        SELECT 'example' AS processor_name, 1 AS record_count, count(*) AS input_rows,
        'completed' AS status FROM w UNION ALL
        SELECT 'minimoon_candidates', count(*) FILTER ({MOON} AND snr >= 5),
        count(*) FILTER (has_ss_source), 'completed' FROM w UNION ALL
        SELECT 'reassociation_tracker', count(DISTINCT dia_source_id), count(*), 'completed'
        FROM w WHERE is_reassociation UNION ALL
        SELECT 'source_summary', (SELECT count(*) FROM (SELECT dia_object_id FROM w
        WHERE dia_object_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 2)), count(*), 'completed'
        FROM w""",
    ),
)


def _results_log(t: Tables) -> DataFrame:
    lake = SG.Lake(scratch_path(t.spark, "results"))
    runner = PR.Runner(_delivered(t, t.flagged, "flagged"), lake)
    for _ in range(2):
        runner.run("minimoon_candidates", window_days=700, as_of=AS_OF_TIME)
    log = lake.read(t.spark, "processor_runs")
    newest = VW.processing_results(log, "minimoon_candidates", 1).select("record_count")
    return RP.processing_summary(log).crossJoin(newest).drop("last_run")


add(
    "processing_summary",
    _results_log,
    with_ctes(
        "alerts",
        f"""SELECT 'minimoon_candidates' AS processor_name, '1.0.0' AS processor_version,
        2 AS run_count, 2 * count(*) AS total_records, count(*) AS record_count
        FROM alerts WHERE {_WIN} AND {MOON} AND snr >= 5""",
    ),
)


# --- saved and materialised filters --------------------------------------------------------------


def _catalog(t: Tables) -> DataFrame:
    catalog = CT.FilterCatalog(t.spark, SG.Lake(scratch_path(t.spark, "catalog")))
    catalog.save(P.high_snr(10.0))
    catalog.save(P.minimoon_candidates())
    catalog.save(P.high_snr(90.0))  # replaces the first
    catalog.delete("minimoon_candidates")
    assert catalog.names() == ["high_snr"]
    return catalog.apply("high_snr", t.alerts)


rows("filter_catalog", _catalog, "WHERE snr >= 90")


def _materialized(t: Tables) -> DataFrame:
    lake = SG.Lake(scratch_path(t.spark, "filtered"))
    CT.materialize_filter(t.alerts.where(F.col("filter_name") == "g"), P.minimoon_candidates(), lake)
    CT.materialize_filter(t.alerts, P.minimoon_candidates(), lake)
    return lake.read(t.spark, "filtered").select("alert_id", "dia_source_id", "filter_config_hash")


add(
    "materialize_filter",
    _materialized,
    with_ctes(
        "alerts",
        f"""SELECT alert_id, dia_source_id, '{P.minimoon_candidates().config_hash()}'
        AS filter_config_hash FROM alerts WHERE {MOON}""",
    ),
)


# --- ingest, batch and stream ------------------------------------------------------------------------


def _as_alerts(rows: DataFrame) -> DataFrame:
    """Fixture rows in the 24-column schema."""
    given = {c: F.col(c) for c in ALERT_COLUMNS if c in rows.columns}
    return rows.select(*[PK.complete(given, c).alias(c) for c in ALERT_COLUMNS])


def _ingested(t: Tables) -> SG.Lake:
    """A lake filled by three runs: early rows, all rows, all rows again."""
    return _fill(t, SG.Lake(scratch_path(t.spark, "lake"), WIDTH))


def _fill(t: Tables, lake: SG.Lake) -> SG.Lake:
    alerts = _as_alerts(t.fx)
    I.ingest(alerts.where(F.col("mjd") < 51000), lake, run_id="first", source_name="part")
    I.ingest(alerts, lake, run_id="second", source_name="rest")
    I.ingest(alerts, lake, run_id="third", source_name="again")
    return lake


add(
    "ingest_runs",
    lambda t: I.latest_runs(t.spark, _ingested(t)).select(
        "run_id",
        "alerts_received",
        "alerts_ingested",
        "alerts_failed",
        "new_sources",
        "updated_sources",
        "status",
    ),
    with_ctes(
        "fx",
        """, k AS (SELECT alert_id, dia_source_id, min(mjd) AS lo FROM fx GROUP BY 1, 2),
        f AS (SELECT DISTINCT alert_id, dia_source_id FROM fx WHERE mjd < 51000),
        s AS (SELECT * FROM k WHERE alert_id NOT IN (SELECT alert_id FROM f))
        SELECT 'first' AS run_id, (SELECT count(*) FROM fx WHERE mjd < 51000) AS alerts_received,
         count(*) AS alerts_ingested, 0 AS alerts_failed,
         count(DISTINCT dia_source_id) AS new_sources,
         count(*) - count(DISTINCT dia_source_id) AS updated_sources, 'completed' AS status FROM f
        UNION ALL SELECT 'second', (SELECT count(*) FROM fx), count(*), 0,
         count(DISTINCT dia_source_id) FILTER (dia_source_id NOT IN (SELECT dia_source_id FROM f)),
         count(*) - count(DISTINCT dia_source_id) FILTER (
           dia_source_id NOT IN (SELECT dia_source_id FROM f)), 'completed' FROM s
        UNION ALL SELECT 'third', (SELECT count(*) FROM fx), 0, 0, 0, 0, 'completed'""",
    ),
)
add(
    "ingested_alerts",
    lambda t: _ingested(t)
    .read(t.spark, "alerts")
    .select("alert_id", "dia_source_id", "mjd", F.col("mjd_day").cast("bigint").alias("mjd_day")),
    with_ctes(
        "fx",
        f"""SELECT alert_id, dia_source_id, mjd, CAST(floor(mjd / {WIDTH}) * {WIDTH} AS BIGINT) AS mjd_day FROM (
        SELECT alert_id, dia_source_id, coalesce(min(mjd) FILTER (mjd < 51000), min(mjd)) AS mjd
        FROM fx GROUP BY 1, 2)""",
    ),
)
add(
    "ingestion_daily",
    lambda t: RP.ingestion_daily(
        I.latest_runs(t.spark, _ingested(t)).withColumn("started_at", F.lit(AS_OF).cast("timestamp"))
    ).select("runs", "total_ingested", "total_failed", "total_new_sources"),
    with_ctes(
        "fx",
        """SELECT 3 AS runs, count(*) AS total_ingested, 0 AS total_failed,
        count(DISTINCT dia_source_id) AS total_new_sources
        FROM (SELECT DISTINCT alert_id, dia_source_id FROM fx)""",
    ),
)
add(
    "run_metrics",
    lambda t: RP.run_metrics(
        I.latest_runs(t.spark, _ingested(t))
    ).select("run_id", "success_rate", "alerts_ingested"),
    with_ctes(
        "fx",
        """SELECT 'first' AS run_id, 100.0 AS success_rate,
        count(DISTINCT alert_id) FILTER (mjd < 51000) AS alerts_ingested FROM fx
        UNION ALL SELECT 'second', 100.0, count(DISTINCT alert_id)
        FILTER (alert_id NOT IN (SELECT alert_id FROM fx WHERE mjd < 51000)) FROM fx
        UNION ALL SELECT 'third', 100.0, 0""",
    ),
)
add(
    "broker_day_summary",
    lambda t: RP.broker_day_summary(I.latest_runs(t.spark, _ingested(t)))
    .agg(*[F.sum(c).alias(c) for c in ("messages_processed", "rows_written", "new_sources")]),
    with_ctes(
        "fx",
        """SELECT (SELECT 2 * count(*) + count(*) FILTER (mjd < 51000) FROM fx)
        AS messages_processed, count(*) AS rows_written,
        count(DISTINCT dia_source_id) AS new_sources
        FROM (SELECT DISTINCT alert_id, dia_source_id FROM fx)""",
    ),
)


def _many_batches(t: Tables, compact_after: tuple[int, ...] = ()) -> SG.Lake:
    """Twelve batches in order of time, every other one shuffled against the store, the last one
    twice. Buckets and merges are small, so that keys and states pass through both."""
    lake = SG.Lake(scratch_path(t.spark, "lake"), WIDTH, bucket_rows=4000, merge_at=3)
    alerts = _delivered(t, _as_alerts(t.alerts), "given") if compact_after else _as_alerts(t.fx)
    step = F.least(F.greatest(F.floor((F.col("mjd") - 48600) / 220), F.lit(0)), F.lit(11))
    for k in (*range(12), 11):
        I.ingest(alerts.where(step == k), lake, run_id=f"batch-{k}", broadcast_rows=10**6 * (k % 2))
        if k in compact_after:
            I.compact(t.spark, lake)
    return lake


def _compacted(t: Tables) -> DataFrame:
    """Twelve batches, compacted after the fourth, the eighth and both times of the last one."""
    return _many_batches(t, (3, 7, 11)).read(t.spark, "alerts")


add(
    "compacted_alerts",
    lambda t: _compacted(t).select("alert_id", "dia_source_id", "mjd", "snr", "run_id"),
    with_ctes(
        "alerts",
        """SELECT alert_id, dia_source_id, mjd, snr, 'batch-' || CAST(least(greatest(floor((mjd - 48600) / 220),
        0), 11) AS INTEGER) AS run_id FROM alerts""",
    ),
)
def _two_runs_compacted(t: Tables) -> DataFrame:
    lake = SG.Lake(scratch_path(t.spark, "lake"), WIDTH)
    alerts = _delivered(t, _as_alerts(t.alerts), "given")
    I.ingest(alerts.where(F.col("mjd") < 51000), lake, run_id="first")
    I.ingest(alerts, lake, run_id="second")
    I.compact(t.spark, lake)
    return lake.read(t.spark, "alerts")


add(
    "in_region_compacted",
    lambda t: VW.in_region(_two_runs_compacted(t), 330.0, 30.0, -10.0, 45.0, wrap=True).select("alert_id", "ra", "dec", "sky_cell"),
    with_ctes(
        "alerts",
        """SELECT alert_id, ra, dec, CAST(least(floor((dec + 90) / 5), 35) * 72 + floor(ra / 5) AS INTEGER)
        AS sky_cell FROM alerts WHERE (ra >= 330 OR ra <= 30) AND dec BETWEEN -10 AND 45""",
    ),
)


add(
    "ingest_many_batches",
    lambda t: I.current_state(t.spark, _many_batches(t)).select(
        "dia_source_id", "first_seen_mjd", "last_seen_mjd", "observation_count", "last_alert_id"
    ),
    with_ctes(
        "fx",
        """, k AS (SELECT alert_id, dia_source_id, min(mjd) AS mjd FROM fx GROUP BY 1, 2)
        SELECT dia_source_id, min(mjd) AS first_seen_mjd, max(mjd) AS last_seen_mjd,
        count(*) AS observation_count, arg_max(alert_id, mjd * 1e12 + alert_id) AS last_alert_id
        FROM k GROUP BY 1""",
    ),
)


# Ten saved filters with the SQL of their rules.
_TEN = [(P.high_snr(x), f"snr >= {x}") for x in (20.0, 40.0, 60.0, 80.0)] + [
    (P.minimoon_candidates(), MOON),
    (P.point_sources(), "extendedness_median < 0.3"),
    (P.extended_sources(), "extendedness_median > 0.7"),
    (P.sso_alerts(), "has_ss_source"),
    (P.by_filter_band("g"), "filter_name = 'g'"),
    (P.by_filter_band("r"), "filter_name = 'r'"),
]


def _materialized_catalog(t: Tables) -> DataFrame:
    """Ten saved filters over two runs, the second seen later; a repeated call adds nothing."""
    lake = SG.Lake(scratch_path(t.spark, "lake"), WIDTH)
    catalog = CT.FilterCatalog(t.spark, lake)
    for k, (config, _) in enumerate(_TEN):
        catalog.save(replace(config, name=f"filter_{k}"))
    alerts = _delivered(t, _as_alerts(t.alerts), "given")
    I.ingest(alerts.where(F.col("mjd") < 51000), lake, run_id="first")
    CT.materialize_catalog(t.spark, lake)
    I.ingest(alerts, lake, run_id="second")
    CT.materialize_catalog(t.spark, lake)
    assert not any(CT.materialize_catalog(t.spark, lake).values())
    stored = lake.read(t.spark, "filtered")
    return stored.select("alert_id", "dia_source_id", F.get_json_object("filter_config", "$.name").alias("name"))


add(
    "materialize_catalog",
    _materialized_catalog,
    with_ctes(
        "alerts",
        " UNION ALL ".join(
            f"SELECT alert_id, dia_source_id, 'filter_{k}' AS name FROM alerts WHERE {test}"
            for k, (_, test) in enumerate(_TEN)
        ),
    ),
)


def _dry_run(t: Tables) -> DataFrame:
    lake = SG.Lake(scratch_path(t.spark, "lake"), WIDTH)
    alerts = _as_alerts(t.fx)
    I.ingest(alerts.where(F.col("mjd") < 51000), lake, run_id="first")
    return I.dry_run(alerts, lake)


add(
    "dry_run",
    _dry_run,
    with_ctes(
        "fx",
        """SELECT count(DISTINCT alert_id) AS would_store FROM fx
        WHERE alert_id NOT IN (SELECT alert_id FROM fx WHERE mjd < 51000)""",
    ),
)


def _line_stream(t: Tables) -> DataFrame:
    """The lineitem table as a stream of fixture alerts."""
    lines = (
        t.spark.readStream.schema(t.table("lineitem").schema)
        .option("pathGlobFilter", "lineitem.parquet")
        .parquet(t.dir)
    )
    return _as_alerts(t.derive(lines))


def _stream_ingest(t: Tables) -> DataFrame:
    lake = SG.Lake(scratch_path(t.spark, "stream-lake"), WIDTH)
    query = SI.start_ingest(_line_stream(t), lake, scratch_path(t.spark, "offsets"), name="lines")
    SI.run_bounded(query)
    return lake.read(t.spark, "alerts").select("alert_id", "dia_source_id", "mjd")


add(
    "stream_ingest",
    _stream_ingest,
    with_ctes(
        "fx", "SELECT alert_id, dia_source_id, min(mjd) AS mjd FROM fx GROUP BY 1, 2"
    ),
)


def _to_parquet(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    out = scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, f"{label}-offsets"))
        .trigger(availableNow=True)
        .start()
    )
    SI.run_bounded(query)
    return spark.read.parquet(out)


add(
    "stream_dedupe",
    lambda t: _to_parquet(
        SI.dedupe_stream(_line_stream(t).select("alert_id", "dia_source_id", "mjd")),
        "deduped",
    ).select("alert_id", "dia_source_id"),
    with_ctes("fx", "SELECT DISTINCT alert_id, dia_source_id FROM fx"),
)


_STATE_COLUMNS = ("alert_id", "dia_source_id", "mjd", "ss_object_id", "ss_object_reassoc_time_mjd")


def _state_stream(t: Tables, parts: list[F.Column], **options) -> DataFrame:
    """The alerts of each part as one run of a stream with state, the next run going on from it."""
    t.spark.conf.set(SR.PROVIDER, SR.ROCKSDB)
    written, out, offsets = (scratch_path(t.spark, f"stream-{x}") for x in ("alerts", "flags", "state"))
    rows = t.alerts.select(*_STATE_COLUMNS)
    for part in parts:
        rows.where(part).write.mode("append").parquet(written)
        stream = t.spark.readStream.schema(rows.schema).parquet(written)
        writer = SR.detect_in_stream(stream, **options).writeStream.format("parquet").option("path", out)
        SI.run_bounded(writer.option("checkpointLocation", offsets).trigger(availableNow=True).start())
    return t.spark.read.parquet(out).drop("ss_object_reassoc_time_mjd")


def _stream_reassociation(t: Tables) -> DataFrame:
    return _state_stream(t, [F.lit(True)])


add(
    "stream_reassociation",
    _stream_reassociation,
    with_ctes(
        "flagged",
        """SELECT alert_id, dia_source_id, mjd, ss_object_id, is_reassociation,
        reassociation_reason, is_new_source FROM flagged""",
    ),
)


_EXPIRING = """SELECT alert_id, dia_source_id, mjd, ss_object_id,
 reassociation_reason IS NOT NULL AND NOT coalesce(mjd - pmjd > 90, false) AS is_reassociation,
 CASE WHEN NOT coalesce(mjd - pmjd > 90, false) THEN reassociation_reason END AS reassociation_reason,
 is_new_source OR mjd - pmjd > 90 AS is_new_source
 FROM (SELECT *, lag(mjd) OVER (PARTITION BY dia_source_id ORDER BY mjd, alert_id) AS pmjd FROM flagged)"""
add(
    "stream_state_expiry",
    lambda t: _state_stream(
        t, [F.col("mjd") < 50400, F.col("mjd") >= 50400], expire_days=90
    ),
    with_ctes("flagged", _EXPIRING),
)
add(
    "stream_state_bootstrap",
    lambda t: _state_stream(
        t,
        [F.col("mjd") >= 50400],
        prior_state=ST.source_state(t.alerts.where("mjd < 50400")),
    ),
    with_ctes(
        "flagged",
        """SELECT alert_id, dia_source_id, mjd, ss_object_id, is_reassociation,
        reassociation_reason, is_new_source FROM flagged WHERE mjd >= 50400""",
    ),
)


# --- files out and back ------------------------------------------------------------------------------


#: JSON repeats all names in each row: compressed quickly, it takes a fifth of the room. A compressed
#: file is read by one task, so none gets more rows than that task should.
JSON_TEXTS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "100000"}


def _round_trip(fmt: str):
    def build(t: Tables) -> DataFrame:
        options = JSON_TEXTS if fmt == "json" else {}
        folder = E.export(
            _as_alerts(t.alerts), f"{scratch_path(t.spark, 'export')}/alerts.{fmt}", fmt, **options
        )
        if fmt == "csv":
            return FS.read_csv_alerts(t.spark, folder)
        if fmt == "json":
            return t.spark.read.schema(_as_alerts(t.alerts).schema).json(folder)
        return FS.read_parquet_alerts(t.spark, folder)

    return build


for _fmt in E.FORMATS:
    rows(f"export_{_fmt}", _round_trip(_fmt), "")


def _camel_csv(t: Tables) -> DataFrame:
    """CSV with the wire-style header, some rows short of a required value or malformed."""
    back = {v: k for k, v in FS.CSV_NAMES.items()}
    spoiled = t.fx.select(
        *[F.col(c).alias(back.get(c, c)) for c in ROW if c != "ra"],
        F.when(F.col("l_linenumber") == 6, F.lit(None)).otherwise(F.col("ra")).alias("ra"),
        F.when(F.col("l_linenumber") == 2, F.lit("bad")).otherwise("1.5").alias("psFlux"),
        F.when(F.col("l_linenumber") == 4, F.col("l_quantity")).alias("trailLength"),
        (F.col("l_suppkey") % 2 == 0).alias("pixelFlagsBad"),
    )
    folder = E.export(spoiled, scratch_path(t.spark, "camel"), "csv")
    return FS.read_alert_files(t.spark, folder, "csv").select(
        *ROW, _map_text("trail_data", True).alias("trail_text"), "ps_flux"
    )


add(
    "csv_scan",
    _camel_csv,
    with_ctes(
        "fx",
        f"""SELECT {ROW_SQL}, CASE WHEN l_linenumber = 4 THEN 'trailLength=' ||
        CAST(floor(l_quantity) AS BIGINT) ELSE '' END AS trail_text, 1.5 AS ps_flux
        FROM fx WHERE l_linenumber NOT IN (2, 6)""",
    ),
)


def _json_packets(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "packets")
    t.packets.write.options(**JSON_TEXTS).json(folder)
    return _flat(FS.read_alert_files(t.spark, folder))


add(
    "json_packet_scan",
    _json_packets,
    with_ctes(
        "fx",
        f"""SELECT {ROW_SQL}, extendedness_max, ss_object_reassoc_time_mjd,
        {_TRAIL_SQL}, {_FLAG_SQL} FROM fx""",
    ),
)


def _daily_append(t: Tables) -> DataFrame:
    # One folder per month: the rows spread thinly over years.
    folder, month = scratch_path(t.spark, "daily"), F.trunc("ingested_at", "month")
    slim = t.fx.select("alert_id", "ingested_at", "snr")
    E.append_daily(slim.where(F.col("snr") < 50), folder, month)
    E.append_daily(slim.where(F.col("snr") >= 50), folder, month)
    return (
        t.spark.read.parquet(folder)
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"), "n")
    )


add(
    "daily_append",
    _daily_append,
    with_ctes(
        "fx",
        """SELECT year(ingested_at) AS year, month(ingested_at) AS month, count(*) AS n FROM fx
        GROUP BY 1, 2""",
    ),
)


def _split(t: Tables) -> DataFrame:
    folder = E.split_by_value(
        t.fx.select("alert_id", F.concat_ws("/", "filter_name", F.lit("a b")).alias("band")),
        "band",
        scratch_path(t.spark, "split"),
    )
    return (
        t.spark.read.option("header", True)
        .csv(folder)
        .groupBy("band", "band_value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


add(
    "split_by_value",
    _split,
    with_ctes(
        "fx",
        """SELECT concat_ws('/', filter_name, 'a b') AS band,
        replace(replace(concat_ws('/', filter_name, 'a b'), '/', '_'), ' ', '_') AS band_value,
        count(*) AS n FROM fx GROUP BY 1, 2""",
    ),
)


def _merge(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "merge")
    columns = ["alert_id", "dia_source_id", "filter_name"]
    E.export(t.fx.select(*columns), f"{base}/a", "csv")
    E.export(t.fx.where("l_linenumber < 4").select(*columns, "mjd"), f"{base}/b", "csv")
    E.merge_csv(
        t.spark,
        [f"{base}/a", f"{base}/b", f"{base}/absent"],
        f"{base}/out",
        dedupe_column="alert_id",
        sort_by="alert_id",
    )
    E.csv_to_json(t.spark, f"{base}/out", f"{base}/json")
    out = t.spark.read.json(f"{base}/json")
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in columns[:2]], "filter_name")


add(
    "merge_files",
    _merge,
    with_ctes("fx", "SELECT DISTINCT alert_id, dia_source_id, filter_name FROM fx"),
)


def _retained(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "retention")
    slim = t.fx.select("alert_id", "dia_source_id", "mjd")
    SG.write_by_day(slim, f"{base}/live", partition_days=60)
    as_of = date.fromisoformat(AS_OF[:10])
    old = E.expire(
        t.spark,
        f"{base}/live",
        365,
        archive=f"{base}/archive",
        as_of=as_of,
        dry_run=False,
        partition_days=60,
    )
    live = t.spark.read.parquet(f"{base}/live").withColumn("place", F.lit("live"))
    if old:
        archived = t.spark.read.parquet(f"{base}/archive").withColumn("place", F.lit("archive"))
        archived = archived.drop("archived_on", "expiry_id")
        live = live.unionByName(archived)
    return live.groupBy("place").agg(
        F.count(F.lit(1)).alias("n"), F.min("mjd").alias("lo"), F.max("mjd").alias("hi")
    )


add(
    "retention",
    _retained,
    with_ctes(
        "fx",
        f"""SELECT CASE WHEN DATE '1858-11-17' + CAST(floor(mjd / 60) * 60 + 59 AS INTEGER) <
        DATE '{AS_OF[:10]}' - 365 THEN 'archive' ELSE 'live' END AS place, count(*) AS n,
        min(mjd) AS lo, max(mjd) AS hi FROM fx GROUP BY 1""",
    ),
)


def _retained_again(t: Tables) -> DataFrame:
    """Two run folders with the same days in one archive, late rows of expired days, a day's retry."""
    base = scratch_path(t.spark, "retention-again")
    slim = t.fx.select("alert_id", "dia_source_id", "mjd", "l_linenumber")
    as_of = date.fromisoformat(AS_OF[:10])
    runs = [f"{base}/live/run_id={name}" for name in "ab"]

    def store(rows: DataFrame, run: str) -> None:
        SG.write_by_day(rows.drop("l_linenumber"), run, "append", partition_days=60)

    def expire(run: str) -> None:
        E.expire(
            t.spark, run, 365, archive=f"{base}/archive", as_of=as_of, dry_run=False, partition_days=60
        )

    store(slim.where("l_linenumber <= 2"), runs[0])
    store(slim.where("l_linenumber IN (3, 4)"), runs[1])
    expire(runs[0])
    store(slim.where("l_linenumber > 4"), runs[0])
    expire(runs[0])
    expire(runs[1])
    expire(runs[1])
    live = t.spark.read.parquet(f"{base}/live").withColumn("place", F.lit("live"))
    archived = t.spark.read.parquet(f"{base}/archive").withColumn("place", F.lit("archive"))
    columns = ["alert_id", "mjd", "place"]
    return live.select(columns).unionByName(archived.select(columns)).groupBy("place").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("mjd").alias("lo"),
        F.max("mjd").alias("hi"),
        F.sum(F.col("alert_id") % 1009).alias("ids"),
    )


add(
    "retention_again",
    _retained_again,
    with_ctes(
        "fx",
        f"""SELECT CASE WHEN DATE '1858-11-17' + CAST(floor(mjd / 60) * 60 + 59 AS INTEGER) <
        DATE '{AS_OF[:10]}' - 365 THEN 'archive' ELSE 'live' END AS place, count(*) AS n,
        min(mjd) AS lo, max(mjd) AS hi, CAST(sum(alert_id % 1009) AS BIGINT) AS ids
        FROM fx GROUP BY 1""",
    ),
)


# --- image stamps --------------------------------------------------------------------------------------

_KINDS_SQL = """, s AS (SELECT *, md5(alert_id || '-' || kind) AS hex, l_tax < 0.08 AS present
 FROM alerts, (SELECT unnest(['science', 'template', 'difference']) AS kind)),
 px AS (SELECT *, list_transform(range(0, 16),
  lambda i: CAST(CAST('0x' || substr(hex, CAST(i * 2 + 1 AS BIGINT), 2) AS INTEGER) AS DOUBLE))
  AS p FROM s)"""
_PIXELS_SQL = """list_transform(range(0, 16), lambda i: CAST(CAST('0x' ||
 substr(md5(alert_id || '-{}'), CAST(i * 2 + 1 AS BIGINT), 2) AS INTEGER) AS DOUBLE))"""
_SCI = "kind = 'science' AND l_linenumber"
_VERDICT = f"""CASE WHEN NOT present OR ({_SCI} = 5) THEN 'absent'
 WHEN {_SCI} IN (6, 7) THEN 'invalid' ELSE 'valid' END"""
add(
    "cutout_classify",
    lambda t: C.planned_paths(
        C.classify_stamps(C.stamps_long(t.stamps)), "out", F.lit(AS_OF).cast("timestamp")
    ).select(
        "alert_id", "dia_source_id", "kind", "verdict", "is_gzip", "stored_bytes", "plain_bytes", "path"
    ),
    with_ctes(
        "alerts",
        f"""{_KINDS_SQL} SELECT alert_id, dia_source_id, kind, {_VERDICT} AS verdict,
        present AND {_SCI} IN (4, 7) AS is_gzip,
        CASE WHEN NOT present THEN NULL WHEN kind = 'science' THEN
          CASE l_linenumber WHEN 4 THEN 2896 + 23 WHEN 5 THEN 0 WHEN 6 THEN 21 WHEN 7 THEN 4
          ELSE 2896 END
        WHEN kind = 'difference' AND l_linenumber = 7 THEN 2880 ELSE 2896 END AS stored_bytes,
        CASE WHEN NOT present THEN NULL WHEN kind = 'science' THEN
          CASE l_linenumber WHEN 5 THEN 0 WHEN 6 THEN 21 WHEN 7 THEN NULL ELSE 2896 END
        WHEN kind = 'difference' AND l_linenumber = 7 THEN 2880 ELSE 2896 END AS plain_bytes,
        CASE WHEN {_VERDICT} = 'valid' THEN concat_ws('/', 'out',
          strftime(DATE '1858-11-17' + CAST(floor(mjd) AS INTEGER), '%Y/%m/%d'),
          dia_source_id || '_' || kind || '_20011028_120000.fits') END AS path FROM s""",
    ),
)
add(
    "cutout_paths",
    lambda t: C.stamp_paths(
        t.stamps,
        "out",
        F.lit(AS_OF).cast("timestamp"),
        by_date=False,
        by_object=True,
        compress=True,
    ),
    with_ctes(
        "alerts",
        f"""{_KINDS_SQL}, n AS (SELECT alert_id, dia_source_id, kind,
        CASE WHEN {_VERDICT} = 'valid' THEN concat_ws('/', 'out', 'obj_' || nullif(dia_object_id, 0),
          dia_source_id || '_' || kind || '_20011028_120000.fits.gz') END AS path FROM s)
        SELECT alert_id, dia_source_id,
        max(path) FILTER (kind = 'science') AS science_cutout_path,
        max(path) FILTER (kind = 'template') AS template_cutout_path,
        max(path) FILTER (kind = 'difference') AS difference_cutout_path FROM n GROUP BY 1, 2""",
    ),
)
_STAT_VERDICT = f"""CASE WHEN NOT present OR ({_SCI} = 5) THEN 'empty'
 WHEN {_SCI} IN (6, 7) THEN 'corrupt'
 WHEN kind = 'difference' AND l_linenumber = 7 THEN 'no_data' ELSE 'valid' END"""
add(
    "cutout_stats",
    lambda t: C.pixel_statistics(C.stamps_long(t.stamps)).select(
        "alert_id",
        "kind",
        "verdict",
        "shape",
        "dtype",
        "min",
        "max",
        r6("mean").alias("mean"),
        r6("median").alias("median"),
        r6("std").alias("std"),
        "has_nan",
        "has_inf",
    ),
    with_ctes(
        "alerts",
        f"""{_KINDS_SQL}, v AS (SELECT *, {_STAT_VERDICT} AS verdict FROM px)
        SELECT alert_id, kind, verdict, CASE WHEN verdict = 'valid' THEN '4x4' END AS shape,
        CASE WHEN verdict = 'valid' THEN 'uint8' END AS dtype,
        CASE WHEN verdict = 'valid' THEN list_min(p) END AS min,
        CASE WHEN verdict = 'valid' THEN list_max(p) END AS max,
        CASE WHEN verdict = 'valid' THEN round(list_avg(p) + 3.1e-9, 6) END AS mean,
        CASE WHEN verdict = 'valid' THEN round(list_median(p) + 3.1e-9, 6) END AS median,
        CASE WHEN verdict = 'valid' THEN round(list_stddev_pop(p) + 3.1e-9, 6) END AS std,
        CASE WHEN verdict = 'valid' THEN false END AS has_nan,
        CASE WHEN verdict = 'valid' THEN false END AS has_inf FROM v""",
    ),
)
add(
    "cutout_verdicts",
    lambda t: C.verdict_counts(C.pixel_statistics(C.stamps_long(t.stamps))),
    with_ctes(
        "alerts",
        f"{_KINDS_SQL} SELECT {_STAT_VERDICT} AS verdict, count(*) AS stamps FROM s GROUP BY 1",
    ),
)
add(
    "cutout_compare",
    lambda t: C.compare_packets(t.stamps).select(
        "alert_id",
        "shape_match",
        "shape",
        near("residual_rms", 4).alias("residual_rms"),
        "diff_peak",
        near("diff_snr", 4).alias("diff_snr"),
    ),
    with_ctes(
        "alerts",
        f""", px AS (SELECT alert_id, {_PIXELS_SQL.format("science")} AS sp,
        {_PIXELS_SQL.format("template")} AS tp, {_PIXELS_SQL.format("difference")} AS dp
        FROM alerts WHERE l_tax < 0.08 AND l_linenumber <= 4),
        c AS (SELECT alert_id, dp, list_transform(range(1, 17), lambda i:
        (sp[CAST(i AS BIGINT)] - tp[CAST(i AS BIGINT)] - dp[CAST(i AS BIGINT)]) ** 2) AS sq FROM px)
        SELECT alert_id, true AS shape_match, '4x4' AS shape,
        round(sqrt(list_avg(sq)) + 3.1e-7, 4) AS residual_rms, list_max(dp) AS diff_peak,
        round(list_max(dp) / list_stddev_pop(dp) + 3.1e-7, 4) AS diff_snr FROM c""",
    ),
)
