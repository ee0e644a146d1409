"""Science presets."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame

from alertlake.functions import exprs as X
from alertlake.operators import filters as f
from alertlake.operators.filters import FilterConfig


def _preset(name, description, *rules, order="mjd", desc=True, limit=None) -> FilterConfig:
    return FilterConfig(name, description, tuple(rules), "AND", order, desc, limit)


def point_sources(limit: int | None = None) -> FilterConfig:
    return _preset(
        "point_sources",
        "Star-like sources, extendedness below 0.3",
        f.is_not_null("extendedness_median"),
        f.lt("extendedness_median", X.POINT_MAX),
        order="snr",
        limit=limit,
    )


def extended_sources(limit: int | None = None) -> FilterConfig:
    return _preset(
        "extended_sources",
        "Galaxy-like sources, extendedness above 0.7",
        f.gt("extendedness_median", X.EXTENDED_MIN),
        order="extendedness_median",
        limit=limit,
    )


def minimoon_candidates(limit: int | None = None) -> FilterConfig:
    return _preset(
        "minimoon_candidates",
        "Solar-system objects of intermediate extendedness",
        f.eq("has_ss_source", True),
        f.between("extendedness_median", X.POINT_MAX, X.EXTENDED_MIN),
        limit=limit,
    )


def sso_alerts(limit: int | None = None) -> FilterConfig:
    return _preset(
        "sso_alerts", "Alerts with a solar-system object", f.eq("has_ss_source", True), limit=limit
    )


def reassociations(limit: int | None = None) -> FilterConfig:
    return _preset(
        "reassociations", "Reassociated alerts", f.eq("is_reassociation", True), limit=limit
    )


def high_snr(min_snr: float = 50.0, limit: int | None = None) -> FilterConfig:
    return _preset(
        "high_snr", f"SNR of at least {min_snr}", f.ge("snr", min_snr), order="snr", limit=limit
    )


def recent_days(
    days: float = 7, limit: int | None = None, as_of: datetime | None = None
) -> FilterConfig:
    start = X.days_ago_mjd(days, as_of)
    return _preset("recent_days", f"The last {days} days", f.ge("mjd", start), limit=limit)


def by_filter_band(band: str, limit: int | None = None) -> FilterConfig:
    return _preset("by_filter_band", f"Band {band}", f.eq("filter_name", band), limit=limit)


def sky_region(
    ra_min: float, ra_max: float, dec_min: float, dec_max: float, limit: int | None = None
) -> FilterConfig:
    """Inclusive box; see ``views.in_region`` for one that wraps at 0/360."""
    return _preset(
        "sky_region",
        f"ra {ra_min}..{ra_max}, dec {dec_min}..{dec_max}",
        f.between("ra", ra_min, ra_max),
        f.between("dec", dec_min, dec_max),
        limit=limit,
    )


def time_window(start_mjd: float, end_mjd: float, limit: int | None = None) -> FilterConfig:
    return _preset(
        "time_window",
        f"mjd {start_mjd}..{end_mjd}",
        f.between("mjd", start_mjd, end_mjd),
        desc=False,
        limit=limit,
    )


def extendedness_range(low: float, high: float, limit: int | None = None) -> FilterConfig:
    return _preset(
        "extendedness_range",
        f"Extendedness {low}..{high}",
        f.between("extendedness_median", low, high),
        order="extendedness_median",
        desc=False,
        limit=limit,
    )


def non_sso(limit: int | None = None) -> FilterConfig:
    return _preset(
        "non_sso", "Alerts without solar-system object", f.eq("has_ss_source", False), limit=limit
    )


def unprocessed(alerts: DataFrame, processed: DataFrame, limit: int | None = None) -> DataFrame:
    """Alerts of sources that are absent from ``processed`` (a table with dia_source_id)."""
    fresh = alerts.join(processed.select("dia_source_id"), "dia_source_id", "left_anti")
    return FilterConfig("unprocessed", order_by="mjd", limit=limit).apply(fresh)


PRESETS: dict[str, Callable[..., FilterConfig]] = {
    p.__name__: p
    for p in (
        point_sources,
        extended_sources,
        minimoon_candidates,
        sso_alerts,
        reassociations,
        high_snr,
        non_sso,
    )
}


def get_preset(name: str, **kwargs) -> FilterConfig:
    try:
        return PRESETS[name](**kwargs)
    except KeyError:
        raise ValueError(f"unknown preset {name!r}; known: {', '.join(PRESETS)}") from None


def list_presets() -> list[dict[str, str]]:
    return [{"name": n, "description": make().description} for n, make in PRESETS.items()]
