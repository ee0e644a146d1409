"""Nested alert packets -> flat alert columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.functions import exprs as X
from alertlake.operators.reassoc import struct_present
from alertlake.schema import ALERT_COLUMNS, ALERT_SCHEMA

# Flat column -> packet member.
DIA_SOURCE_FIELDS = {
    "dia_source_id": "diaSourceId",
    "dia_object_id": "diaObjectId",
    "ra": "ra",
    "dec": "decl",
    "mjd": "midPointTai",
    "filter_name": "filterName",
    "ps_flux": "psFlux",
    "ps_flux_err": "psFluxErr",
    "snr": "snr",
    "extendedness_median": "extendednessMedian",
    "extendedness_min": "extendednessMin",
    "extendedness_max": "extendednessMax",
}
# What an absent member counts as.
DEFAULTS = {"alert_id": 0, "dia_source_id": 0, "ra": 0.0, "dec": 0.0, "mjd": 0.0}


def member(parent: Column, parent_type: T.DataType | None, name: str, dtype: T.DataType) -> Column:
    """``parent.name`` as ``dtype``; a typed null where the schema has no such member."""
    if isinstance(parent_type, T.StructType) and name in parent_type.fieldNames():
        return parent[name].cast(dtype)
    return X.typed_null(dtype)


def prefix_map(
    value_of: Callable[[str], Column], names: list[str], prefix: str, value: T.DataType
) -> Column:
    """Map of all non-null members whose name starts with ``prefix``; names come from the
    schema at plan time, so the map costs no per-row reflection."""
    found = [n for n in names if n.startswith(prefix)]
    empty = F.create_map().cast(T.MapType(T.StringType(), value))
    if not found:
        return empty
    pairs = [x for n in found for x in (F.lit(n), value_of(n).cast(value))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def flat_columns(packet_type: T.StructType, packet: Column | None = None) -> list[Column]:
    """The flat columns (without cutout bytes) of a packet struct, or of a packet row."""

    def top(name: str) -> tuple[Column | None, T.DataType | None]:
        if name not in packet_type.fieldNames():
            return None, None
        return (F.col(name) if packet is None else packet[name]), packet_type[name].dataType

    source, source_type = top("diaSource")
    sso, sso_type = top("ssObject")
    alert_id, _ = top("alertId")
    source_names = source_type.fieldNames() if isinstance(source_type, T.StructType) else []
    sso_names = tuple(sso_type.fieldNames()) if isinstance(sso_type, T.StructType) else ()

    out = {"alert_id": X.typed_null(T.LongType()) if alert_id is None else alert_id.cast("long")}
    for flat, nested in DIA_SOURCE_FIELDS.items():
        out[flat] = member(source, source_type, nested, ALERT_SCHEMA[flat].dataType)
    for flat, default in DEFAULTS.items():
        out[flat] = F.coalesce(out[flat], F.lit(default).cast(ALERT_SCHEMA[flat].dataType))
    out["filter_name"] = X.clean_band(out["filter_name"])

    out["has_ss_source"] = F.lit(False) if not sso_names else struct_present(sso, sso_names)
    out["ss_object_id"] = X.clean_text(member(sso, sso_type, "ssObjectId", T.StringType()))
    out["ss_object_reassoc_time_mjd"] = member(
        sso, sso_type, "ssObjectReassocTimeMjdTai", T.DoubleType()
    )
    out["trail_data"] = prefix_map(lambda n: source[n], source_names, "trail", T.DoubleType())
    out["pixel_flags"] = prefix_map(
        lambda n: source[n], source_names, "pixelFlags", T.BooleanType()
    )
    return [complete(out, name).alias(name) for name in ALERT_COLUMNS]


def complete(given: dict[str, Column], name: str) -> Column:
    """A given column (NaN as null) or the default of a flat column."""
    dtype = ALERT_SCHEMA[name].dataType
    if name in given:
        value = given[name]
        return X.nan_to_null(value) if isinstance(dtype, T.DoubleType) else value
    if name == "ingested_at":
        return F.current_timestamp()
    if name in ("is_reassociation", "has_ss_source"):
        return F.lit(False)
    if isinstance(dtype, T.MapType):
        return F.create_map().cast(dtype)
    return X.typed_null(dtype)


def with_verdict(rows: DataFrame, name: str, verdict: Column) -> DataFrame:
    """Add a boolean that is made from finished columns. A filter on a plain column is moved below the
    columns it looks at, and what they cost, such as parsing a text, is then paid again for it."""
    return rows.select("*", F.explode(F.array(verdict)).alias(name))


def flatten_packet(packets: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One flat row per packet; ``keep`` passes packet columns (cutout bytes) through."""
    return packets.select(*flat_columns(packets.schema), *keep)
