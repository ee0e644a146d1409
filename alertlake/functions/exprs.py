"""Scalar column expressions; all of them stay inside generated JVM code."""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Epochs and conversions.
MJD_UNIX_EPOCH = 40587.0  # MJD of 1970-01-01
JD_MINUS_MJD = 2400000.5
SECONDS_PER_DAY = 86400.0
MJD_DAY_ZERO = "1858-11-17"

# Band codes of the portal rows.
BAND_BY_CODE = {1: "g", 2: "r", 3: "i"}

# Limits of the extendedness classes.
POINT_MAX = 0.3
EXTENDED_MIN = 0.7


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time -------------------------------------------------------------------


def timestamp_to_mjd(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp")) / (SECONDS_PER_DAY * 1e6) + MJD_UNIX_EPOCH


def mjd_to_timestamp(mjd: Column | str) -> Column:
    micros = F.round((col(mjd) - MJD_UNIX_EPOCH) * SECONDS_PER_DAY * 1e6)
    return F.timestamp_micros(micros.cast("long"))


def mjd_to_date(mjd: Column | str) -> Column:
    return F.date_add(F.lit(MJD_DAY_ZERO).cast("date"), F.floor(col(mjd)).cast("int"))


def mjd_day(mjd: Column | str, partition_days: int = 1) -> Column:
    """Partition value of the alert table: first day of the partition."""
    if partition_days == 1:
        return F.floor(col(mjd)).cast("int")
    return (F.floor(col(mjd) / partition_days) * partition_days).cast("int")


def jd_to_mjd(jd: Column | str) -> Column:
    return col(jd) - JD_MINUS_MJD


def as_of_mjd(as_of: datetime | None = None) -> float:
    """MJD of a driver-side instant; naive values are UTC."""
    moment = as_of or datetime.now(timezone.utc)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.timestamp() / SECONDS_PER_DAY + MJD_UNIX_EPOCH


def days_ago_mjd(days: float, as_of: datetime | None = None) -> float:
    return as_of_mjd(as_of) - days


# --- photometry ---------------------------------------------------------------


def mag_to_flux(mag: Column | str) -> Column:
    return F.pow(F.lit(10.0), col(mag) * -0.4)


def mag_to_flux_err(mag: Column | str, mag_err: Column | str) -> Column:
    err = col(mag_err)
    return F.when(err > 0, mag_to_flux(mag) * err * (0.4 * math.log(10)))


def snr_from_sigma(sigma: Column | str) -> Column:
    s = col(sigma)
    return F.when(s > 0, F.lit(1.0) / s)


def extendedness_from_classifier(star_score: Column | str) -> Column:
    return F.lit(1.0) - col(star_score)


def band_from_code(code: Column | str) -> Column:
    pairs = [F.lit(x) for item in BAND_BY_CODE.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(code)), F.lit("unknown"))


# --- identifiers, text --------------------------------------------------------


def stable_id(text: Column | str) -> Column:
    """60-bit integer from the leading 15 hex digits of the md5."""
    digits = F.substring(F.md5(col(text).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def times_1000_low64(value: Column | str) -> Column:
    """``value * 1000`` kept to its low 64 bits: a 60-bit id times 1000 does not fit a BIGINT.

    Distinct 60-bit inputs stay distinct, and products that fit are unchanged.
    """
    two64 = F.lit(str(2**64)).cast("decimal(38,0)")
    low = F.pmod(col(value).cast("decimal(20,0)") * F.lit(1000).cast("decimal(4,0)"), two64)
    signed = F.when(low >= F.lit(str(2**63)).cast("decimal(38,0)"), low - two64).otherwise(low)
    return signed.cast("long")


def clean_text(text: Column | str) -> Column:
    return F.trim(col(text))


def clean_band(text: Column | str) -> Column:
    return F.lower(F.trim(col(text)))


def partition_safe(value: Column | str) -> Column:
    return F.translate(col(value).cast("string"), "/ ", "__")


def clamp(value: Column | str, low: float, high: float) -> Column:
    v = col(value)
    return F.when(v.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), v)))


def nan_to_null(value: Column | str) -> Column:
    v = col(value)
    return F.when(~F.isnan(v), v)


# --- derived figures ----------------------------------------------------------


def sky_area(ra_min: Column, ra_max: Column, dec_min: Column, dec_max: Column, dec_avg: Column):
    """Rectangular estimate in square degrees."""
    return (ra_max - ra_min) * (dec_max - dec_min) * F.cos(F.radians(dec_avg))


def extendedness_class(ext: Column | str) -> Column:
    """A missing value counts as intermediate."""
    e = col(ext)
    return (
        F.when(e < POINT_MAX, "point").when(e > EXTENDED_MIN, "extended").otherwise("intermediate")
    )


def per_second(count: Column | str, seconds: Column | str) -> Column:
    s = col(seconds)
    return F.when(s > 0, col(count) / s)


def percent(part: Column | str, whole: Column | str, if_empty: float) -> Column:
    w = col(whole)
    return F.when(w > 0, col(part) * 100.0 / w).otherwise(F.lit(if_empty))


def cutout_path(
    base: str,
    mjd: Column | str,
    source_id: Column | str,
    kind: Column | str,
    written_at: Column,
    *,
    object_id: Column | None = None,
    by_date: bool = True,
    compress: bool = False,
) -> Column:
    """Planned path of a stamp: ``base/YYYY/MM/DD[/obj_ID]/SOURCE_KIND_TIME.fits[.gz]``."""
    parts = [F.lit(base.rstrip("/"))]
    if by_date:
        parts.append(F.date_format(mjd_to_timestamp(mjd), "yyyy/MM/dd"))
    if object_id is not None:
        # concat_ws leaves out a null part; object 0 counts as no object
        parts.append(
            F.when(object_id != 0, F.concat(F.lit("obj_"), object_id.cast("string")))
        )
    stamp = F.date_format(written_at, "yyyyMMdd_HHmmss")
    name = F.concat_ws("_", col(source_id).cast("string"), col(kind), stamp)
    parts.append(F.concat(name, F.lit(".fits.gz" if compress else ".fits")))
    return F.concat_ws("/", *parts)


def typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)
