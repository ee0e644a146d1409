"""Broker objects (loci) with their alert history -> flat alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.operators.reassoc import (
    RECENT_DAYS,
    association_by_tag,
    flag_recent,
    struct_present,
)
from alertlake.schema import ALERT_COLUMNS, ALERT_SCHEMA
from alertlake.sources.packets import DIA_SOURCE_FIELDS, complete, prefix_map


def association(props: Column, packet_sso: Column, tags: Column) -> tuple[Column, Column, Column]:
    """(has association, object id, reassociation time): properties, then packet, then tags."""
    by_props = props["ssObjectId"].isNotNull()
    by_packet = ~by_props & struct_present(packet_sso)
    by_tag = ~by_props & ~by_packet & association_by_tag(tags)
    object_id = F.when(by_props, props["ssObjectId"]).when(by_packet, packet_sso["ssObjectId"])
    time = F.when(by_props, props["ssObjectReassocTimeMjdTai"]).when(
        by_packet, packet_sso["ssObjectReassocTimeMjdTai"]
    )
    return by_props | by_packet | by_tag, object_id, time


def _to_alerts(rows: DataFrame) -> DataFrame:
    """Rows with one history element in ``alert``, and the locus's ra, dec, tags."""
    alert_type = rows.schema["alert"].dataType
    assert isinstance(alert_type, T.StructType)
    prop_names = alert_type["properties"].dataType.fieldNames()
    alert, props = F.col("alert"), F.col("alert.properties")
    has_sso, object_id, time = association(props, alert["packet"]["ssObject"], F.col("tags"))

    given = {
        flat: props[nested].cast(ALERT_SCHEMA[flat].dataType)
        for flat, nested in DIA_SOURCE_FIELDS.items()
        if nested in prop_names
    }
    # Only a missing value falls back: 0.0 is a legal coordinate.
    given["ra"] = F.coalesce(given["ra"], F.col("ra"))
    given["dec"] = F.coalesce(given["dec"], F.col("dec"))
    given["mjd"] = F.coalesce(given["mjd"], alert["mjd"])
    given["dia_source_id"] = F.coalesce(given["dia_source_id"], F.lit(0).cast("long"))
    given["filter_name"] = F.lower(F.trim(given["filter_name"]))
    given |= {
        "alert_id": alert["alert_id"].try_cast("long"),
        "has_ss_source": has_sso,
        "ss_object_id": object_id,
        "ss_object_reassoc_time_mjd": time,
        "trail_data": prefix_map(lambda n: props[n], prop_names, "trail", T.DoubleType()),
        "pixel_flags": prefix_map(lambda n: props[n], prop_names, "pixelFlags", T.BooleanType()),
    }
    flat = rows.select(*[complete(given, n).alias(n) for n in ALERT_COLUMNS])
    return flag_recent(flat, RECENT_DAYS).where(F.col("alert_id").isNotNull())


def locus_latest(loci: DataFrame) -> DataFrame:
    """One alert per locus, its last; none for an empty history."""
    rows = loci.where(F.size("alerts") > 0).withColumn("alert", F.element_at("alerts", -1))
    return _to_alerts(rows.drop("alerts"))


def locus_history(loci: DataFrame) -> DataFrame:
    """One alert per element of each history."""
    return _to_alerts(loci.withColumn("alert", F.explode("alerts")).drop("alerts"))
