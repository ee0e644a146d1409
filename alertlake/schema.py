"""Fixed schemas of the alert lake."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of the 24 flat alert columns and their types.
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.LongType()),
        T.StructField("dia_source_id", T.LongType()),
        T.StructField("dia_object_id", T.LongType()),
        T.StructField("ra", T.DoubleType()),
        T.StructField("dec", T.DoubleType()),
        T.StructField("mjd", T.DoubleType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("filter_name", T.StringType()),
        T.StructField("ps_flux", T.DoubleType()),
        T.StructField("ps_flux_err", T.DoubleType()),
        T.StructField("snr", T.DoubleType()),
        T.StructField("extendedness_median", T.DoubleType()),
        T.StructField("extendedness_min", T.DoubleType()),
        T.StructField("extendedness_max", T.DoubleType()),
        T.StructField("has_ss_source", T.BooleanType()),
        T.StructField("ss_object_id", T.StringType()),
        T.StructField("ss_object_reassoc_time_mjd", T.DoubleType()),
        T.StructField("is_reassociation", T.BooleanType()),
        T.StructField("reassociation_reason", T.StringType()),
        T.StructField("trail_data", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("pixel_flags", T.MapType(T.StringType(), T.BooleanType())),
        T.StructField("science_cutout_path", T.StringType()),
        T.StructField("template_cutout_path", T.StringType()),
        T.StructField("difference_cutout_path", T.StringType()),
    ]
)
ALERT_COLUMNS = ALERT_SCHEMA.fieldNames()

ALERT_KEY = ("alert_id", "dia_source_id")

# Order in which the observations of one source count as "arrived".
ARRIVAL_ORDER = ("mjd", "alert_id")

# Nested packet; `trail*` and `pixelFlags*` members may vary between surveys.
DIA_SOURCE = T.StructType(
    [T.StructField("diaSourceId", T.LongType()), T.StructField("diaObjectId", T.LongType())]
    + [T.StructField(n, T.DoubleType()) for n in ("ra", "decl", "midPointTai")]
    + [T.StructField("filterName", T.StringType())]
    + [
        T.StructField(n, T.DoubleType())
        for n in (
            "psFlux",
            "psFluxErr",
            "snr",
            "extendednessMedian",
            "extendednessMin",
            "extendednessMax",
            "trailLength",
            "trailAngle",
            "trailWidth",
        )
    ]
    + [
        T.StructField(n, T.BooleanType())
        for n in ("pixelFlagsBad", "pixelFlagsCr", "pixelFlagsEdge", "pixelFlagsSaturated")
    ]
)
SS_OBJECT = T.StructType(
    [
        T.StructField("ssObjectId", T.StringType()),
        T.StructField("ssObjectReassocTimeMjdTai", T.DoubleType()),
    ]
)
CUTOUT_FIELDS = ("cutoutScience", "cutoutTemplate", "cutoutDifference")
PACKET_SCHEMA = T.StructType(
    [
        T.StructField("alertId", T.LongType()),
        T.StructField("diaSource", DIA_SOURCE),
        T.StructField("ssObject", SS_OBJECT),
    ]
    + [T.StructField(n, T.BinaryType()) for n in CUTOUT_FIELDS]
)

# One broker object with the ordered history of its alerts.
LOCUS_PROPERTIES = T.StructType(
    list(DIA_SOURCE.fields) + list(SS_OBJECT.fields)
)
LOCUS_SCHEMA = T.StructType(
    [
        T.StructField("locus_id", T.StringType()),
        T.StructField("ra", T.DoubleType()),
        T.StructField("dec", T.DoubleType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField(
            "alerts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("alert_id", T.StringType()),
                        T.StructField("mjd", T.DoubleType()),
                        T.StructField("properties", LOCUS_PROPERTIES),
                        T.StructField(
                            "packet", T.StructType([T.StructField("ssObject", SS_OBJECT)])
                        ),
                    ]
                )
            ),
        ),
    ]
)

# Broker-portal JSON rows.
PORTAL_SCHEMA = T.StructType(
    [
        T.StructField("i:candid", T.LongType()),
        T.StructField("i:objectId", T.StringType()),
        T.StructField("i:ra", T.DoubleType()),
        T.StructField("i:dec", T.DoubleType()),
        T.StructField("i:jd", T.DoubleType()),
        T.StructField("i:fid", T.IntegerType()),
        T.StructField("i:magpsf", T.DoubleType()),
        T.StructField("i:sigmapsf", T.DoubleType()),
        T.StructField("i:classtar", T.DoubleType()),
        T.StructField("d:roid", T.IntegerType()),
        T.StructField("i:ssnamenr", T.StringType()),
        T.StructField("sso_name", T.StringType()),
    ]
)

SOURCE_STATE_SCHEMA = T.StructType(
    [
        T.StructField("dia_source_id", T.LongType()),
        T.StructField("first_seen_mjd", T.DoubleType()),
        T.StructField("last_seen_mjd", T.DoubleType()),
        T.StructField("observation_count", T.LongType()),
        T.StructField("ss_object_id", T.StringType()),
        T.StructField("ss_object_reassoc_time", T.DoubleType()),
        T.StructField("last_alert_id", T.LongType()),
    ]
)

# One row per event of an ingestion run; the newest event of a run_id is its state.
RUN_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("source_config", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("alerts_received", T.LongType()),
        T.StructField("alerts_ingested", T.LongType()),
        T.StructField("alerts_failed", T.LongType()),
        T.StructField("new_sources", T.LongType()),
        T.StructField("updated_sources", T.LongType()),
        T.StructField("reassociations_detected", T.LongType()),
        T.StructField("cutouts_saved", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("event_at", T.TimestampType()),
    ]
)

# One row per processor run; the records themselves live in a typed table per processor.
PROCESSOR_RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("processor_name", T.StringType()),
        T.StructField("processor_version", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("summary", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("window_start_mjd", T.DoubleType()),
        T.StructField("window_end_mjd", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
    ]
)

FILTER_LOG_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("config_json", T.StringType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("saved_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)
