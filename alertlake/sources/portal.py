"""Broker-portal JSON rows -> flat alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.functions import exprs as X
from alertlake.schema import ALERT_COLUMNS, PORTAL_SCHEMA
from alertlake.sources.packets import complete


def _c(name: str):
    return F.col(f"`{name}`")


def portal_to_alerts(rows: DataFrame) -> DataFrame:
    """Rows lacking id, object id, position or date are left out; an id, object id or date
    of zero or empty counts as lacking."""
    candid, object_id, jd = _c("i:candid"), _c("i:objectId"), _c("i:jd")
    usable = (
        F.coalesce(candid != 0, F.lit(False))
        & F.coalesce(object_id != "", F.lit(False))
        & _c("i:ra").isNotNull()
        & _c("i:dec").isNotNull()
        & F.coalesce(jd != 0, F.lit(False))
    )
    mag, sigma = _c("i:magpsf"), _c("i:sigmapsf")
    ext = X.extendedness_from_classifier(_c("i:classtar"))
    number = F.nullif(F.nullif(_c("i:ssnamenr"), F.lit("null")), F.lit(""))
    given = {
        "alert_id": candid,
        "dia_source_id": candid,
        "dia_object_id": X.stable_id(object_id),
        "ra": _c("i:ra"),
        "dec": _c("i:dec"),
        "mjd": X.jd_to_mjd(jd),
        "filter_name": X.band_from_code(F.coalesce(_c("i:fid"), F.lit(0))),
        "ps_flux": X.mag_to_flux(mag),
        "ps_flux_err": X.mag_to_flux_err(mag, sigma),
        "snr": X.snr_from_sigma(sigma),
        "extendedness_median": ext,
        "extendedness_min": ext,
        "extendedness_max": ext,
        "has_ss_source": F.coalesce(_c("d:roid") > 0, F.lit(False)),
        "ss_object_id": F.coalesce(number, F.nullif(_c("sso_name"), F.lit(""))),
    }
    return rows.where(usable).select(*[complete(given, n).alias(n) for n in ALERT_COLUMNS])


def read_portal_json(
    spark: SparkSession, paths: str | list[str], *, multi_line: bool = True
) -> DataFrame:
    """Files holding a JSON array each (``multi_line``) or JSON lines, which also split."""
    rows = spark.read.schema(PORTAL_SCHEMA).option("multiLine", multi_line).json(paths)
    return portal_to_alerts(rows)
