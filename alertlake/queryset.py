"""Every registered query with the SQL it must agree with (None: no SQL form).

Each query reads whole benchmark tables through ``fixture.Tables``. Doubles that come out of
sums or means are rounded, counts are BIGINT, dates are text, so that engines compare.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.fixture import AS_OF, Tables, with_ctes
from alertlake.functions import exprs as X
from alertlake.operators import aggregates as A
from alertlake.operators import dedupe as D
from alertlake.operators import filters as f
from alertlake.operators import presets as P
from alertlake.operators import reassoc as R
from alertlake.operators import sets as S
from alertlake.operators import state as ST
from alertlake.operators import validate as V
from alertlake.operators import views as VW
from alertlake.plans import reports as RP

AS_OF_TIME = datetime.fromisoformat(AS_OF)


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def add(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = Query(build, sql)


# Means are moved off the exact half before rounding, in Spark and in the SQL alike, because
# engines whose last bits differ would round a tie differently.
def near(c: Column | str, digits: int) -> Column:
    return F.round(X.col(c) + {6: 3.1e-9, 4: 3.1e-7}[digits], digits)


def r6(c: Column | str) -> Column:
    return near(c, 6)


def big(c: Column | str) -> Column:
    return X.col(c).cast("bigint")


def text(c: Column | str) -> Column:
    return X.col(c).cast("string")


# --- row filters over the deduplicated alerts ------------------------------------------

ROW = (
    "alert_id",
    "dia_source_id",
    "dia_object_id",
    "ra",
    "dec",
    "mjd",
    "filter_name",
    "snr",
    "extendedness_median",
    "has_ss_source",
    "ss_object_id",
)
ROW_SQL = ", ".join(ROW)


def rows(name: str, build: Callable[[Tables], DataFrame], where: str, upto: str = "alerts"):
    """A query that returns whole rows; ``where`` is the SQL tail after FROM <upto>."""
    add(
        name,
        lambda t: build(t).select(*ROW),
        with_ctes(upto, f"SELECT {ROW_SQL} FROM {upto} {where}"),
    )


def rule(name: str, *rules: f.Rule, where: str, mode: str = "AND"):
    config = f.FilterConfig(name, conditions=rules, combine_with=mode)
    rows(name, lambda t: config.apply(t.alerts), f"WHERE {where}")


rule("flt_eq", f.eq("filter_name", "g"), where="filter_name = 'g'")
rule("flt_ne", f.ne("filter_name", "g"), where="filter_name <> 'g'")
rule("flt_lt", f.lt("snr", 10.0), where="snr < 10")
rule("flt_le", f.le("extendedness_median", 0.3), where="extendedness_median <= 0.3")
rule("flt_gt", f.gt("mjd", 51000.5), where="mjd > 51000.5")
rule("flt_ge", f.ge("snr", 50.0), where="snr >= 50")
rule("flt_in", f.in_list("filter_name", ["g", "r"]), where="filter_name IN ('g', 'r')")
rule("flt_not_in", f.not_in_list("filter_name", ["g", "r"]), where="filter_name NOT IN ('g', 'r')")
rule("flt_ilike", f.like("ss_object_id", "sso%3"), where="ss_object_id ILIKE 'sso%3'")
rule("flt_is_null", f.is_null("extendedness_median"), where="extendedness_median IS NULL")
rule("flt_is_not_null", f.is_not_null("dia_object_id"), where="dia_object_id IS NOT NULL")
rule("flt_between", f.between("dec", -30.0, 30.0), where="dec BETWEEN -30 AND 30")
rule(
    "flt_and_or",
    f.eq("has_ss_source", 1),
    f.gt("snr", 90.0),
    f.is_null("filter_name"),
    where="has_ss_source OR snr > 90 OR filter_name IS NULL",
    mode="OR",
)
rows("flt_no_conditions", lambda t: f.FilterConfig().apply(t.alerts), "")
rows(
    "flt_json_roundtrip",
    lambda t: f.FilterConfig.from_json(
        f.FilterConfig(conditions=(f.between("mjd", 50000, 51000), f.ne("filter_name", "u"))).to_json()
    ).apply(t.alerts),
    "WHERE mjd BETWEEN 50000 AND 51000 AND filter_name <> 'u'",
)
rows(
    "quick_filter",
    lambda t: f.quick_filter(
        t.flagged,
        extendedness_min=0.2,
        extendedness_max=0.9,
        snr_min=20.0,
        has_sso=True,
        is_reassociation=True,
        filter_name="r",
        mjd_min=50000.0,
        mjd_max=52000.0,
    ),
    """WHERE extendedness_median >= 0.2 AND extendedness_median <= 0.9 AND snr >= 20
    AND has_ss_source AND is_reassociation AND filter_name = 'r'
    AND mjd >= 50000 AND mjd <= 52000""",
    upto="flagged",
)
rows(
    "quick_filter_extra",
    lambda t: f.quick_filter(
        t.alerts, exclude_sso=True, snr_max=60.0, filters=["g", "i"], ra_min=90.0, dec_max=0.0
    ),
    """WHERE NOT has_ss_source AND snr <= 60 AND filter_name IN ('g', 'i')
    AND ra >= 90 AND dec <= 0""",
)
rows(
    "row_function_filter",
    lambda t: f.filter_rows(t.alerts, (F.col("snr") > 30) & (F.col("ra") + F.col("dec") > 100)),
    "WHERE snr > 30 AND ra + dec > 100",
)

# presets
MOON = "has_ss_source AND extendedness_median BETWEEN 0.3 AND 0.7"
RECENT_MJD = X.days_ago_mjd(7, AS_OF_TIME)
for _name, _make, _where in (
    ("preset_point_sources", P.point_sources(), "extendedness_median < 0.3"),
    ("preset_extended_sources", P.extended_sources(), "extendedness_median > 0.7"),
    ("preset_minimoon", P.minimoon_candidates(), MOON),
    ("preset_sso", P.sso_alerts(), "has_ss_source"),
    ("preset_high_snr", P.high_snr(80.0), "snr >= 80"),
    ("preset_recent_days", P.recent_days(7, as_of=AS_OF_TIME), f"mjd >= {RECENT_MJD!r}"),
    ("preset_band", P.by_filter_band("i"), "filter_name = 'i'"),
    (
        "preset_sky_region",
        P.sky_region(90.0, 180.0, -30.0, 30.0),
        "ra BETWEEN 90 AND 180 AND dec BETWEEN -30 AND 30",
    ),
    ("preset_time_window", P.time_window(50500.0, 50600.0), "mjd BETWEEN 50500 AND 50600"),
    (
        "preset_ext_range",
        P.extendedness_range(0.4, 0.5),
        "extendedness_median BETWEEN 0.4 AND 0.5",
    ),
    ("preset_non_sso", P.non_sso(), "NOT has_ss_source"),
):
    rows(_name, lambda t, c=_make: c.apply(t.alerts), f"WHERE {_where}")
rows(
    "preset_reassociations",
    lambda t: P.get_preset("reassociations").apply(t.flagged),
    "WHERE is_reassociation",
    upto="flagged",
)
rows(
    "unprocessed_alerts",
    lambda t: P.unprocessed(
        t.alerts, ST.source_state(t.alerts.where(F.col("mjd") < 50500))
    ),
    """WHERE dia_source_id NOT IN (SELECT dia_source_id FROM alerts WHERE mjd < 50500)""",
)

# views and shortcuts
rows("view_point_sources", lambda t: VW.point_sources(t.alerts), "WHERE extendedness_median < 0.3")
rows(
    "view_extended_sources",
    lambda t: VW.extended_sources(t.alerts),
    "WHERE extendedness_median > 0.7",
)
rows("view_minimoon", lambda t: VW.minimoon_candidates(t.alerts), f"WHERE {MOON}")
rows(
    "today_ingest",
    lambda t: VW.today_ingest(t.alerts, AS_OF_TIME),
    f"WHERE CAST(ingested_at AS DATE) = CAST(TIMESTAMP '{AS_OF}' AS DATE)",
)
rows(
    "recent_ingest",
    lambda t: VW.recent_ingest(t.alerts, 7, AS_OF_TIME),
    f"WHERE ingested_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY",
)
rows(
    "recent_by_mjd",
    lambda t: VW.recent(t.alerts, 30, AS_OF_TIME),
    f"WHERE mjd >= {X.days_ago_mjd(30, AS_OF_TIME)!r}",
)
rows("by_source", lambda t: VW.by_source(t.alerts, 42), "WHERE dia_source_id = 42")
rows("by_object", lambda t: VW.by_object(t.alerts, 42), "WHERE dia_object_id = 42")
rows("by_sso", lambda t: VW.by_sso(t.alerts, "SSO_2"), "WHERE ss_object_id = 'SSO_2'")
rows(
    "in_region",
    lambda t: VW.in_region(t.alerts, 0.0, 60.0, -10.0, 45.0),
    "WHERE ra BETWEEN 0 AND 60 AND dec BETWEEN -10 AND 45",
)
rows(
    "in_region_wrapped",
    lambda t: VW.in_region(t.alerts, 330.0, 30.0, -10.0, 45.0, wrap=True),
    "WHERE (ra >= 330 OR ra <= 30) AND dec BETWEEN -10 AND 45",
)
rows(
    "in_time_window",
    lambda t: VW.in_time_window(t.alerts, 51000.0, 51010.0),
    "WHERE mjd BETWEEN 51000 AND 51010",
)
rows("with_filter", lambda t: VW.with_filter(t.alerts, "z"), "WHERE filter_name = 'z'")
rows("high_snr", lambda t: VW.high_snr(t.alerts), "WHERE snr >= 50")
rows(
    "view_reassociations",
    lambda t: VW.reassociations(t.flagged),
    "WHERE is_reassociation",
    upto="flagged",
)
rows("view_sso_alerts", lambda t: VW.sso_alerts(t.alerts), "WHERE has_ss_source")
rows(
    "processing_window",
    lambda t: VW.processing_window(t.alerts, 15),
    "WHERE mjd >= (SELECT max(mjd) FROM alerts) - 15",
)
rows(
    "topk_snr",
    lambda t: P.high_snr(0.0, limit=25).apply(t.alerts),
    "WHERE snr >= 0 ORDER BY snr DESC NULLS LAST, alert_id, dia_source_id LIMIT 25",
)
rows(
    "limit_newest",
    lambda t: VW.processing_window(t.alerts, 60, limit=100),
    """WHERE mjd >= (SELECT max(mjd) FROM alerts) - 60
    ORDER BY mjd DESC NULLS LAST, alert_id, dia_source_id LIMIT 100""",
)


def _custom_sql(t: Tables) -> DataFrame:
    VW.register_views(t.flagged)
    return VW.custom(
        t.spark,
        """SELECT filter_name, CAST(count(*) AS BIGINT) AS n, round(avg(snr) + 3.1e-9, 6) AS avg_snr
           FROM v_sso_alerts WHERE mjd >= ? AND snr >= ? GROUP BY filter_name""",
        [50000.0, 5.0],
    )


add(
    "custom_sql",
    _custom_sql,
    with_ctes(
        "alerts",
        """SELECT filter_name, CAST(count(*) AS BIGINT) AS n, round(avg(snr) + 3.1e-9, 6) AS avg_snr
        FROM alerts WHERE has_ss_source AND mjd >= 50000 AND snr >= 5 GROUP BY filter_name""",
    ),
)

# --- validation --------------------------------------------------------------------------

_SPOIL = {
    "ra": "CASE WHEN l_partkey % 11 = 0 THEN ra + 200 ELSE ra END",
    "dec": "CASE WHEN l_suppkey % 13 = 0 THEN dec * 2 ELSE dec END",
    "snr": "snr - 10",
    "extendedness_median": "extendedness_median * 1.25",
    "extendedness_min": "extendedness_min - 0.1",
    "mjd": "CASE WHEN l_linenumber = 3 AND l_tax >= 0.08 THEN 0.0 ELSE mjd END",
    "dia_source_id": "CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE dia_source_id END",
}
_RULES_SQL = ", ".join(
    f"CASE WHEN {broken} THEN '{name}' END"
    for name, broken in (
        ("alert_id_required", "alert_id IS NULL"),
        ("dia_source_id_required", "dia_source_id IS NULL"),
        ("ra_range", "ra IS NULL OR ra < 0 OR ra > 360"),
        ("dec_range", "dec IS NULL OR dec < -90 OR dec > 90"),
        ("snr_range", "snr < 0"),
        ("extendedness_median_range", "extendedness_median < 0 OR extendedness_median > 1"),
        ("extendedness_min_range", "extendedness_min < 0 OR extendedness_min > 1"),
        ("extendedness_max_range", "extendedness_max < 0 OR extendedness_max > 1"),
        ("mjd_positive", "mjd IS NULL OR mjd <= 0"),
    )
)
_SPOILED_SQL = "SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in _SPOIL.items()) + ") FROM fx"


def _spoiled(t: Tables) -> DataFrame:
    return t.fx.withColumns({c: F.expr(e) for c, e in _SPOIL.items()})


add(
    "validate_rejects",
    lambda t: V.validate_alerts(_spoiled(t))[1].select(
        "alert_id", "l_partkey", "l_suppkey", F.array_join(V.FAILED, ",").alias("failed")
    ),
    with_ctes(
        "fx",
        f"""SELECT * FROM (SELECT alert_id, l_partkey, l_suppkey,
        concat_ws(',', {_RULES_SQL}) AS failed FROM ({_SPOILED_SQL})) WHERE failed <> ''""",
    ),
)
add(
    "validate_accepts",
    lambda t: V.validate_alerts(_spoiled(t))[0].select("alert_id", "l_partkey", "l_suppkey", "snr"),
    with_ctes(
        "fx",
        f"""SELECT alert_id, l_partkey, l_suppkey, snr FROM ({_SPOILED_SQL})
        WHERE concat_ws(',', {_RULES_SQL}) = ''""",
    ),
)

# --- per-key ordering ------------------------------------------------------------------------

rows("dedupe_alerts", lambda t: t.alerts, "")
add(
    "dedupe_by_column",
    lambda t: D.dedupe_by_column(
        t.fx, "dia_object_id", ["mjd", "alert_id", "l_suppkey", "l_quantity", "ps_flux"]
    ).select("dia_object_id", "alert_id", "mjd", "ps_flux"),
    with_ctes(
        "fx",
        """SELECT dia_object_id, alert_id, mjd, ps_flux FROM (SELECT *, row_number() OVER (
        PARTITION BY dia_object_id ORDER BY mjd, alert_id, l_suppkey, l_quantity, ps_flux) AS rn
        FROM fx) WHERE rn = 1""",
    ),
)
add(
    "distinct_rows",
    lambda t: S.distinct_rows(t.fx.select("dia_source_id", "filter_name", "has_ss_source")),
    with_ctes("fx", "SELECT DISTINCT dia_source_id, filter_name, has_ss_source FROM fx"),
)
add(
    "latest_per_object",
    lambda t: D.latest_per_key(
        t.alerts.where(F.col("dia_object_id").isNotNull()),
        ["dia_object_id"],
        ["mjd", "alert_id", "dia_source_id"],
    ).select("dia_object_id", "alert_id", "mjd"),
    with_ctes(
        "alerts",
        """SELECT dia_object_id, alert_id, mjd FROM (SELECT *, row_number() OVER (
        PARTITION BY dia_object_id ORDER BY mjd DESC, alert_id DESC, dia_source_id DESC) AS rn
        FROM alerts WHERE dia_object_id IS NOT NULL) WHERE rn = 1""",
    ),
)

# --- association history ---------------------------------------------------------------------

_FLAG_COLS = (
    "alert_id, dia_source_id, mjd, ss_object_id, is_reassociation, reassociation_reason, "
    "is_new_source"
)
add(
    "detect_reassociations",
    lambda t: t.flagged.select(*_FLAG_COLS.split(", ")),
    with_ctes("flagged", f"SELECT {_FLAG_COLS} FROM flagged"),
)


def _half_state(t: Tables) -> DataFrame:
    return ST.source_state(t.alerts.where(F.col("mjd") < 51000))


add(
    "detect_with_prior_state",
    lambda t: R.detect_reassociations(
        t.alerts.where(F.col("mjd") >= 51000), _half_state(t)
    ).select(*_FLAG_COLS.split(", ")),
    with_ctes("flagged", f"SELECT {_FLAG_COLS} FROM flagged WHERE mjd >= 51000"),
)
add(
    "recent_reassociation_flag",
    lambda t: R.flag_recent(t.alerts).select(
        "alert_id", "dia_source_id", "is_reassociation", "reassociation_reason"
    ),
    with_ctes(
        "alerts",
        """SELECT alert_id, dia_source_id, coalesce(has_ss_source AND gap <= 1, false)
        AS is_reassociation, CASE WHEN has_ss_source AND gap <= 1 THEN
        printf('Recent SSObject reassociation (dt=%.3f days)', gap) END AS reassociation_reason
        FROM (SELECT *, abs(ss_object_reassoc_time_mjd - mjd) AS gap FROM alerts)""",
    ),
)
_KNOWN = (
    "extendedness_median IS NOT NULL AND extendedness_min IS NOT NULL "
    "AND extendedness_max IS NOT NULL"
)
_IN = "extendedness_median BETWEEN 0.2 AND 0.8 AND extendedness_min >= 0.25 AND extendedness_max <= 0.95"
_NEAR = "coalesce(abs(ss_object_reassoc_time_mjd - mjd) <= 1, false)"
_PF = dict(median_low=0.2, median_high=0.8, min_low=0.25, max_high=0.95)
rows(
    "broker_filter_v2",
    lambda t: R.PassFilter(**_PF).on_alerts(t.alerts),
    f"WHERE {_KNOWN} AND has_ss_source AND (({_IN}) OR {_NEAR})",
)
rows(
    "broker_filter_v2_exclude",
    lambda t: R.PassFilter(**_PF, require_sso=False).on_alerts(t.alerts),
    f"WHERE {_KNOWN} AND NOT has_ss_source AND {_IN}",
)
rows(
    "broker_filter_v1",
    lambda t: R.PassFilter(**_PF, reassociation=False).on_alerts(t.alerts),
    f"WHERE {_KNOWN} AND has_ss_source AND {_IN}",
)

# --- joins, set operations ---------------------------------------------------------------------

rows(
    "already_stored_anti",
    lambda t: S.not_stored(t.alerts, t.alerts.where(F.col("filter_name") == "g")),
    "WHERE alert_id NOT IN (SELECT alert_id FROM alerts WHERE filter_name = 'g')",
)
rows(
    "filtered_semi",
    lambda t: S.stored_rows_of(P.minimoon_candidates().apply(t.alerts, ordered=False), t.alerts),
    f"WHERE {MOON}",
)
add(
    "prior_state_join",
    lambda t: ST.with_prior_state(t.alerts, _half_state(t)).select(
        "alert_id",
        "dia_source_id",
        "has_prior_state",
        "prior_last_seen_mjd",
        "prior_observation_count",
    ),
    with_ctes(
        "alerts",
        """SELECT alert_id, a.dia_source_id, s.hi IS NOT NULL AS has_prior_state,
        s.hi AS prior_last_seen_mjd, s.n AS prior_observation_count FROM alerts a LEFT JOIN (
        SELECT dia_source_id, max(mjd) AS hi, count(*) AS n FROM alerts WHERE mjd < 51000
        GROUP BY 1) s ON a.dia_source_id = s.dia_source_id""",
    ),
)
add(
    "union_missing_columns",
    lambda t: S.concat_differing(
        [
            t.fx.where("l_linenumber <= 3").select("alert_id", "mjd", "snr"),
            t.fx.where("l_linenumber > 3").select("filter_name", "alert_id", "ra"),
        ]
    ),
    with_ctes(
        "fx",
        """SELECT alert_id, CAST(NULL AS VARCHAR) AS filter_name, mjd, CAST(NULL AS DOUBLE) AS ra,
        snr FROM fx WHERE l_linenumber <= 3 UNION ALL SELECT alert_id, filter_name, NULL, ra, NULL
        FROM fx WHERE l_linenumber > 3""",
    ),
)
add(
    "concat_sources",
    lambda t: S.concat([t.fx.select("alert_id", "mjd"), t.alerts.select("alert_id", "mjd")]),
    with_ctes(
        "alerts", "SELECT alert_id, mjd FROM fx UNION ALL SELECT alert_id, mjd FROM alerts"
    ),
)

# --- rollups ---------------------------------------------------------------------------------------

add(
    "alert_stats",
    lambda t: A.alert_stats(t.alerts).withColumns({c: r6(c) for c in ("ext_mean", "ext_std")}),
    with_ctes(
        "alerts",
        """SELECT count(*) AS total_alerts, count(DISTINCT dia_source_id) AS unique_sources,
        count(DISTINCT dia_object_id) AS unique_objects, min(mjd) AS min_mjd, max(mjd) AS max_mjd,
        round(avg(extendedness_median) + 3.1e-9, 6) AS ext_mean,
        round(stddev_samp(extendedness_median) + 3.1e-9, 6) AS ext_std,
        count(*) FILTER (extendedness_median < 0.3) AS point_sources,
        count(*) FILTER (extendedness_median > 0.7) AS extended_sources,
        count(*) FILTER (has_ss_source) AS with_sso,
        count(*) FILTER (NOT has_ss_source) AS without_sso FROM alerts""",
    ),
)
add(
    "source_summary",
    lambda t: A.source_summary(t.alerts).withColumns(
        {
            "extendedness_mean": r6("extendedness_mean"),
            "extendedness_std": r6("extendedness_std"),
            "filters": F.array_join("filters", ","),
        }
    ),
    with_ctes(
        "alerts",
        """SELECT dia_object_id, count(*) AS detection_count, min(mjd) AS first_mjd,
        max(mjd) AS last_mjd, max(mjd) - min(mjd) AS time_span_days,
        round(avg(extendedness_median) + 3.1e-9, 6) AS extendedness_mean,
        round(stddev_samp(extendedness_median) + 3.1e-9, 6) AS extendedness_std,
        min(extendedness_median) AS extendedness_lowest,
        max(extendedness_median) AS extendedness_highest,
        coalesce(string_agg(DISTINCT filter_name, ',' ORDER BY filter_name), '') AS filters,
        bool_or(has_ss_source) AS has_sso_detection
        FROM alerts WHERE dia_object_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 2""",
    ),
)
add(
    "reassociation_tracker",
    lambda t: A.reassociation_tracker(t.flagged).withColumns(
        {c: F.array_join(c, ",") for c in ("reasons", "ss_objects")}
    ),
    with_ctes(
        "flagged",
        """SELECT dia_source_id, count(*) AS reassociation_count, min(mjd) AS first_reassoc_mjd,
        max(mjd) AS last_reassoc_mjd, count(DISTINCT ss_object_id) AS ss_object_count,
        string_agg(DISTINCT reassociation_reason, ',' ORDER BY reassociation_reason) AS reasons,
        string_agg(DISTINCT ss_object_id, ',' ORDER BY ss_object_id) AS ss_objects
        FROM flagged WHERE is_reassociation GROUP BY 1""",
    ),
)
add(
    "reassociation_pairs",
    lambda t: A.reassociation_pairs(t.flagged),
    with_ctes(
        "flagged",
        """SELECT dia_source_id, ss_object_id, count(*) AS reassociation_count,
        min(mjd) AS first_reassoc_mjd, max(mjd) AS last_reassoc_mjd
        FROM flagged WHERE is_reassociation GROUP BY 1, 2""",
    ),
)
add(
    "sso_summary",
    lambda t: A.sso_summary(t.flagged).withColumn("avg_extendedness", r6("avg_extendedness")),
    with_ctes(
        "flagged",
        """SELECT ss_object_id, count(*) AS alert_count,
        count(DISTINCT dia_source_id) AS source_count, min(mjd) AS first_mjd, max(mjd) AS last_mjd,
        round(avg(extendedness_median) + 3.1e-9, 6) AS avg_extendedness,
        count(*) FILTER (is_reassociation) AS reassociations
        FROM flagged WHERE has_ss_source GROUP BY 1""",
    ),
)
_STATE_SQL = """SELECT dia_source_id, min(mjd) AS first_seen_mjd, max(mjd) AS last_seen_mjd,
 count(*) AS observation_count, {ID} AS ss_object_id, {TIME} AS ss_object_reassoc_time,
 max(CASE WHEN _last THEN alert_id END) AS last_alert_id
 FROM (SELECT *, row_number() OVER (PARTITION BY dia_source_id ORDER BY mjd DESC, alert_id DESC) = 1
 AS _last FROM alerts) GROUP BY 1"""
_LAST_ROW = _STATE_SQL.format(
    ID="max(CASE WHEN _last THEN ss_object_id END)",
    TIME="max(CASE WHEN _last THEN ss_object_reassoc_time_mjd END)",
)
_CARRIED = _STATE_SQL.format(
    ID="arg_max(ss_object_id, mjd * 1e9 + alert_id) FILTER (ss_object_id IS NOT NULL)",
    TIME="arg_max(ss_object_reassoc_time_mjd, mjd * 1e9 + alert_id) "
    "FILTER (ss_object_reassoc_time_mjd IS NOT NULL)",
)
add("source_state", lambda t: ST.source_state(t.alerts), with_ctes("alerts", _LAST_ROW))
add(
    "source_state_carried",
    lambda t: ST.source_state(t.alerts, carry_forward=True),
    with_ctes("alerts", _CARRIED),
)
add(
    "source_state_merged",
    lambda t: ST.merge_states(
        _half_state(t).unionByName(ST.source_state(t.alerts.where(F.col("mjd") >= 51000)))
    ),
    with_ctes("alerts", _LAST_ROW),
)
add(
    "source_arcs",
    lambda t: ST.source_arcs(ST.source_state(t.alerts)),
    with_ctes(
        "alerts",
        f"""SELECT dia_source_id, observation_count, first_seen_mjd, last_seen_mjd,
        last_seen_mjd - first_seen_mjd AS arc_length_days, ss_object_id, ss_object_reassoc_time
        FROM ({_LAST_ROW})""",
    ),
)
add(
    "state_overlap",
    lambda t: ST.sources_in_window(ST.source_state(t.alerts), 50500.0, 50520.0),
    with_ctes(
        "alerts",
        f"""SELECT * FROM ({_LAST_ROW}) WHERE last_seen_mjd >= 50500
        AND first_seen_mjd <= 50520""",
    ),
)
add(
    "state_expiry",
    lambda t: ST.expire_state(ST.source_state(t.alerts), 90, AS_OF_TIME),
    with_ctes(
        "alerts",
        f"SELECT * FROM ({_LAST_ROW}) WHERE last_seen_mjd >= {X.days_ago_mjd(90, AS_OF_TIME)!r}",
    ),
)
add(
    "new_vs_updated",
    lambda t: ST.new_vs_updated(t.alerts.where(F.col("mjd") >= 51000), _half_state(t)).select(
        big("new_sources").alias("new_sources"), big("updated_sources").alias("updated_sources")
    ),
    with_ctes(
        "flagged",
        """SELECT count(*) FILTER (is_new_source) AS new_sources,
        count(*) FILTER (NOT is_new_source) AS updated_sources FROM flagged WHERE mjd >= 51000""",
    ),
)
add(
    "storage_stats",
    lambda t: A.storage_stats(t.flagged),
    with_ctes(
        "flagged",
        """SELECT count(*) AS alert_count, min(mjd) AS min_mjd, max(mjd) AS max_mjd,
        count(*) FILTER (has_ss_source) AS sso_count,
        count(*) FILTER (is_reassociation) AS reassociation_count FROM flagged""",
    ),
)
add(
    "table_counts",
    lambda t: A.table_counts(
        {"raw": t.fx, "alerts": t.alerts, "state": t.alerts.select("dia_source_id").distinct()}
    ),
    with_ctes(
        "alerts",
        """SELECT 'raw' AS table_name, count(*) AS row_count FROM fx UNION ALL
        SELECT 'alerts', count(*) FROM alerts UNION ALL
        SELECT 'state', count(DISTINCT dia_source_id) FROM alerts""",
    ),
)
add(
    "band_summary",
    lambda t: A.band_summary(t.alerts).withColumn("avg_extendedness", r6("avg_extendedness")),
    with_ctes(
        "alerts",
        """SELECT filter_name, count(*) AS alert_count,
        round(avg(extendedness_median) + 3.1e-9, 6) AS avg_extendedness FROM alerts GROUP BY 1""",
    ),
)
add(
    "alerts_by_date",
    lambda t: A.alerts_by_ingest_date(t.alerts).withColumn("ingest_date", text("ingest_date")),
    with_ctes(
        "alerts",
        """SELECT CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS ingest_date,
        count(*) AS alert_count FROM alerts GROUP BY 1""",
    ),
)
add(
    "extendedness_classes",
    lambda t: A.extendedness_classes(t.alerts),
    with_ctes(
        "alerts",
        """SELECT CASE WHEN extendedness_median < 0.3 THEN 'point' WHEN extendedness_median > 0.7
        THEN 'extended' ELSE 'intermediate' END AS class, count(*) AS alert_count
        FROM alerts GROUP BY 1""",
    ),
)
add(
    "minimoon_arcs",
    lambda t: A.minimoon_arcs(t.alerts, 3).withColumn("mean_extendedness", r6("mean_extendedness")),
    with_ctes(
        "alerts",
        f"""SELECT ss_object_id, count(*) AS observation_count,
        round(avg(extendedness_median) + 3.1e-9, 6) AS mean_extendedness, min(mjd) AS first_mjd,
        max(mjd) AS last_mjd FROM alerts WHERE {MOON} AND ss_object_id IS NOT NULL
        GROUP BY 1 HAVING count(*) >= 3""",
    ),
)
add(
    "dataset_stats",
    lambda t: A.dataset_stats(
        t.packets.select("diaSource.*", F.col("ssObject").isNotNull().alias("hasSSSource"))
    ).select(
        "rows",
        big("columns").alias("columns"),
        F.array_join("trail_columns", ",").alias("trail_columns"),
        F.array_join("pixel_flag_columns", ",").alias("pixel_flag_columns"),
        "sso_count",
        r6("sso_rate").alias("sso_rate"),
    ),
    with_ctes(
        "fx",
        """SELECT count(*) AS rows, CAST(20 AS BIGINT) AS columns,
        'trailLength,trailAngle,trailWidth' AS trail_columns,
        'pixelFlagsBad,pixelFlagsCr,pixelFlagsEdge,pixelFlagsSaturated' AS pixel_flag_columns,
        count(*) FILTER (has_ss_source) AS sso_count,
        round(avg(CASE WHEN has_ss_source THEN 1.0 ELSE 0.0 END) + 3.1e-9, 6) AS sso_rate FROM fx""",
    ),
)

# --- reports ---------------------------------------------------------------------------------------

_DATE_SQL = "CAST(DATE '1858-11-17' + CAST(floor(mjd) AS INTEGER) AS DATE)"
_BANDS_SQL = ", ".join(
    f"count(*) FILTER (filter_name = '{b}') AS alerts_{b}" for b in RP.BANDS
) + ", count(*) FILTER (filter_name NOT IN ('u','g','r','i','z','y')) AS alerts_other"
_R_DAILY = (
    "ext_mean", "ext_std", "area_sq_deg", "flux_mean", "flux_median", "flux_std",
    "snr_mean", "snr_median",
)
_AREA_SQL = "(max(ra)-min(ra))*(max(dec)-min(dec))*cos(radians(avg(dec)))"
add(
    "daily_report",
    lambda t: RP.daily_report(t.alerts).withColumns(
        {"date": text("date"), **{c: near(c, 4) for c in _R_DAILY}}
    ),
    with_ctes(
        "alerts",
        f"""SELECT CAST({_DATE_SQL} AS VARCHAR) AS date, count(*) AS total_alerts,
        count(DISTINCT dia_object_id) AS unique_objects,
        count(DISTINCT dia_source_id) AS unique_sources, {_BANDS_SQL},
        count(*) FILTER (has_ss_source) AS with_sssource,
        count(*) FILTER (NOT has_ss_source) AS without_sssource,
        round(avg(extendedness_median) + 3.1e-7, 4) AS ext_mean,
        round(stddev_samp(extendedness_median) + 3.1e-7, 4) AS ext_std,
        min(extendedness_median) AS ext_min, max(extendedness_median) AS ext_max,
        min(ra) AS ra_min, max(ra) AS ra_max, min(dec) AS dec_min, max(dec) AS dec_max,
        round({_AREA_SQL} + 3.1e-7, 4) AS area_sq_deg,
        round(avg(ps_flux) + 3.1e-7, 4) AS flux_mean, round(median(ps_flux) + 3.1e-7, 4) AS flux_median,
        round(stddev_samp(ps_flux) + 3.1e-7, 4) AS flux_std, round(avg(snr) + 3.1e-7, 4) AS snr_mean,
        round(median(snr) + 3.1e-7, 4) AS snr_median, count(*) FILTER (snr > 5) AS snr_above_5,
        count(*) FILTER (snr > 10) AS snr_above_10 FROM alerts GROUP BY 1""",
    ),
)
add(
    "band_counts_by_date",
    lambda t: RP.band_counts_by_date(t.alerts).withColumn("date", text("date")),
    with_ctes(
        "alerts",
        f"""SELECT CAST({_DATE_SQL} AS VARCHAR) AS date, filter_name, count(*) AS alert_count
        FROM alerts WHERE filter_name IS NOT NULL GROUP BY 1, 2""",
    ),
)
add(
    "monthly_report",
    lambda t: RP.monthly_report(t.alerts).withColumns(
        {
            "year": big("year"),
            "month": big("month"),
            "avg_alerts_per_day": r6("avg_alerts_per_day"),
            "sso_fraction": r6("sso_fraction"),
        }
    ),
    with_ctes(
        "alerts",
        f"""SELECT m.*, o.unique_objects FROM (SELECT year(d) AS year, month(d) AS month,
        CAST(sum(n) AS BIGINT) AS total_alerts, count(*) AS days_with_data,
        round(avg(n) + 3.1e-9, 6) AS avg_alerts_per_day, max(n) AS max_daily_alerts,
        min(n) AS min_daily_alerts,
        {", ".join(f"CAST(sum(alerts_{b}) AS BIGINT) AS alerts_{b}" for b in (*RP.BANDS, "other"))},
        CAST(sum(sso) AS BIGINT) AS with_sssource, round(sum(sso) / sum(n) + 3.1e-9, 6) AS sso_fraction
        FROM (SELECT {_DATE_SQL} AS d, count(*) AS n, count(*) FILTER (has_ss_source) AS sso,
              {_BANDS_SQL} FROM alerts GROUP BY 1) GROUP BY 1, 2) m
        JOIN (SELECT year({_DATE_SQL}) AS year, month({_DATE_SQL}) AS month,
              count(DISTINCT dia_object_id) AS unique_objects FROM alerts GROUP BY 1, 2) o
        ON m.year = o.year AND m.month = o.month""",
    ),
)
add(
    "sky_area",
    lambda t: RP.sky_area(t.alerts).select(
        "ra_min",
        "ra_max",
        "dec_min",
        "dec_max",
        r6("dec_mean").alias("dec_mean"),
        near("area_sq_deg", 4).alias("area_sq_deg"),
    ),
    with_ctes(
        "alerts",
        f"""SELECT min(ra) AS ra_min, max(ra) AS ra_max, min(dec) AS dec_min, max(dec) AS dec_max,
        round(avg(dec) + 3.1e-9, 6) AS dec_mean, round({_AREA_SQL} + 3.1e-7, 4) AS area_sq_deg FROM alerts""",
    ),
)

# --- scalar expressions --------------------------------------------------------------------------

add(
    "scalar_expressions",
    lambda t: t.fx.select(
        "alert_id",
        "l_partkey",
        "l_suppkey",
        near(X.timestamp_to_mjd("ingested_at"), 6).alias("ingest_mjd"),
        F.date_format(X.mjd_to_timestamp("mjd"), "yyyy-MM-dd HH:mm:ss").alias("observed"),
        near(X.jd_to_mjd(F.col("mjd") + 2400000.5), 6).alias("mjd_again"),
        r6(X.mag_to_flux(F.col("l_quantity") / 10)).alias("flux"),
        r6(X.mag_to_flux_err(F.col("l_quantity") / 10, "l_discount")).alias("flux_err"),
        r6(X.snr_from_sigma("l_discount")).alias("snr_est"),
        X.band_from_code("l_linenumber").alias("band"),
        X.stable_id(F.col("l_partkey").cast("string")).alias("hashed"),
        X.clamp(F.col("dec") * 2, -90.0, 90.0).alias("clamped"),
        F.pmod(F.col("dec"), F.lit(360.0)).alias("turned"),
        X.partition_safe(F.concat_ws("/", "l_returnflag", F.lit("a b"))).alias("safe"),
        X.extendedness_class("extendedness_median").alias("class"),
        X.cutout_path(
            "stamps",
            "mjd",
            "dia_source_id",
            F.lit("science"),
            F.col("ingested_at"),
            object_id=F.col("dia_object_id"),
            compress=True,
        ).alias("path"),
    ),
    with_ctes(
        "fx",
        """SELECT alert_id, l_partkey, l_suppkey,
        round(epoch_us(ingested_at) / 86400e6 + 40587 + 3.1e-9, 6) AS ingest_mjd,
        strftime(make_timestamp(CAST(round((mjd - 40587) * 86400e6) AS BIGINT)),
                 '%Y-%m-%d %H:%M:%S') AS observed,
        round(mjd + 2400000.5 - 2400000.5 + 3.1e-9, 6) AS mjd_again,
        round(pow(10, -0.4 * (l_quantity / 10)) + 3.1e-9, 6) AS flux,
        CASE WHEN l_discount > 0 THEN
          round(0.4 * ln(10) * pow(10, -0.4 * (l_quantity / 10)) * l_discount + 3.1e-9, 6) END AS flux_err,
        CASE WHEN l_discount > 0 THEN round(1.0 / l_discount + 3.1e-9, 6) END AS snr_est,
        CASE l_linenumber WHEN 1 THEN 'g' WHEN 2 THEN 'r' WHEN 3 THEN 'i' ELSE 'unknown' END AS band,
        CAST('0x' || substr(md5(CAST(l_partkey AS VARCHAR)), 1, 15) AS BIGINT) AS hashed,
        greatest(-90, least(90, dec * 2)) AS clamped,
        CASE WHEN dec < 0 THEN dec + 360 ELSE dec END AS turned,
        l_returnflag || '_a_b' AS safe,
        CASE WHEN extendedness_median < 0.3 THEN 'point' WHEN extendedness_median > 0.7
        THEN 'extended' ELSE 'intermediate' END AS class,
        concat_ws('/', 'stamps',
          strftime(DATE '1858-11-17' + CAST(floor(mjd) AS INTEGER), '%Y/%m/%d'),
          CASE WHEN dia_object_id <> 0 THEN 'obj_' || dia_object_id END,
          dia_source_id || '_science_' || strftime(ingested_at, '%Y%m%d_%H%M%S') || '.fits.gz')
          AS path FROM fx""",
    ),
)
