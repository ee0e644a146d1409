"""Hand-made rows with expectations worked out by hand."""

import gzip
import json
import math
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from alertlake.functions import exprs as X
from alertlake.operators import aggregates, cutouts, dedupe, filters, presets, reassoc, skew, state
from alertlake.operators import validate
from alertlake.operators.quantiles import exact_medians
from alertlake.schema import LOCUS_SCHEMA, PACKET_SCHEMA, PORTAL_SCHEMA
from alertlake.sources import locus, packets, portal, wire

ROWS = "alert_id long, dia_source_id long, mjd double, ss_object_id string, ss_object_reassoc_time_mjd double"


def history(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_reassociation_cases(spark):
    rows = [
        (1, 7, 100.0, None, None),  # first sighting
        (2, 7, 101.0, "A", 1.0),  # appeared
        (3, 7, 102.0, "B", 1.0),  # changed
        (4, 7, 103.0, "B", 2.0),  # re-timed
        (5, 7, 104.0, None, None),  # lost: no flag
        (6, 7, 105.0, "B", 2.0),  # appeared again
        (7, 8, 100.0, "Z", 1.0),  # first sighting with an object
    ]
    out = reassoc.detect_reassociations(history(spark, rows)).orderBy("alert_id").collect()
    assert [r["reassociation_reason"] for r in out] == [
        None,
        reassoc.NEW,
        reassoc.CHANGED,
        reassoc.UPDATED,
        None,
        reassoc.NEW,
        None,
    ]
    assert [r["is_new_source"] for r in out] == [True, False, False, False, False, False, True]


def test_reassociation_uses_prior_state(spark):
    prior = state.source_state(history(spark, [(1, 7, 100.0, "A", 1.0), (2, 9, 1.0, "Q", None)]))
    out = reassoc.detect_reassociations(
        history(spark, [(5, 7, 101.0, "B", 1.0), (6, 8, 101.0, "B", 1.0)]), prior
    ).orderBy("alert_id")
    assert [(r["reassociation_reason"], r["is_new_source"]) for r in out.collect()] == [
        (reassoc.CHANGED, False),
        (None, True),
    ]


@pytest.mark.parametrize("tasks", [1, 2, 7, 100])
@pytest.mark.parametrize("hot", [0, 3, 1])
def test_previous_row_equals_plain_lag(spark, tasks, hot):
    """No source, a third of the rows or all of them hot, many rows at one instant, null keys and values."""
    share = F.col("id") % hot == 0 if hot else F.lit(False)
    source = F.when(share, 1).otherwise(F.when(F.col("id") % 50 > 1, F.col("id") % 50))
    base = spark.range(900).select(
        F.col("id").alias("alert_id"),
        source.cast("long").alias("dia_source_id"),
        F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.col("id") / 10).alias("mjd"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), "id")).alias("name"),
        F.create_map(F.lit("k"), "id").alias("kept"),
    )
    order, values = ("mjd", "alert_id"), ("alert_id", "name")
    found = skew.with_previous(base, "dia_source_id", order, values, tasks=tasks)
    assert found.columns == [*base.columns, skew.PREVIOUS]
    last: dict = {}
    want = {}
    for r in sorted(base.collect(), key=lambda r: (r["mjd"], r["alert_id"])):
        want[r["alert_id"]] = last.get(r["dia_source_id"])
        last[r["dia_source_id"]] = (r["alert_id"], r["name"])
    got = {r["alert_id"]: r[skew.PREVIOUS] for r in found.collect()}
    assert {k: v and tuple(v) for k, v in got.items()} == want
    assert skew.has_hot_key(base, "dia_source_id", 200) == bool(hot)
    plain = skew.with_previous(base, "dia_source_id", order, values, any_hot=False)
    assert {r["alert_id"]: r[skew.PREVIOUS] and tuple(r[skew.PREVIOUS]) for r in plain.collect()} == want


def test_previous_row_shuffles_rows_once(spark, tables):
    rows = tables.fx.select("alert_id", "dia_source_id", "mjd", "ss_object_id")
    found = skew.with_previous(rows, "dia_source_id", ("mjd", "alert_id"), ("ss_object_id",))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("+- Exchange rangepartitioning") == 1 and plan.count("ReusedExchange") == 1
    assert plan.count("hashpartitioning") == 0 and plan.count("SinglePartition") == 1


def test_dedupe_limits_groups_before_the_shuffle(spark, tables):
    plan = dedupe.dedupe_alerts(tables.fx, ["mjd"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_filters_reach_the_parquet_scan(spark, tables):
    lines = tables.table("lineitem")
    plan = (
        filters.FilterConfig(conditions=(filters.gt("l_quantity", 40.0),))
        .apply(lines)
        .select("l_orderkey")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "GreaterThan(l_quantity,40.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_exact_medians_of_skewed_groups(spark):
    rows = [("a", float(i % 997) ** 2) for i in range(5000)] + [("b", 1.0)] * 300
    rows += [("b", 2.0)] * 300 + [("c", 4.0)] + [("c", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["v_median"] for r in exact_medians(frame, ["k"], ["v"]).collect()}
    for key in "abc":
        assert got[key] == statistics.median(v for k, v in rows if k == key and v is not None)


def test_validation_names_broken_rules(spark):
    schema = (
        "alert_id long, dia_source_id long, ra double, dec double, mjd double, snr double, "
        "extendedness_median double, extendedness_min double, extendedness_max double"
    )
    rows = [
        (1, 1, 360.0, -90.0, 1.0, None, None, None, None),
        (2, None, 361.0, 0.0, 0.0, -1.0, 1.5, 0.0, 1.0),
    ]
    good, bad = validate.validate_alerts(spark.createDataFrame(rows, schema))
    assert [r["alert_id"] for r in good.collect()] == [1]
    assert bad.first()["failed_rules"] == [
        "dia_source_id_required",
        "ra_range",
        "snr_range",
        "extendedness_median_range",
        "mjd_positive",
    ]


def test_filter_errors_and_presets():
    with pytest.raises(ValueError):
        filters.Rule("a", "~", 1)
    with pytest.raises(ValueError):
        presets.get_preset("nope")
    assert len(presets.list_presets()) == 7
    config = presets.sky_region(1, 2, 3, 4, limit=5)
    assert filters.FilterConfig.from_json(config.to_json()) == config
    assert len(config.config_hash()) == 16


def test_in_needs_a_list(spark):
    with pytest.raises(ValueError):
        filters.Rule("id", "IN", 3).column()


def test_row_function_fallback(spark):
    out = filters.filter_rows(spark.range(10), lambda row: row["id"] % 4 == 1)
    assert [r["id"] for r in out.collect()] == [1, 5, 9]


def test_object_summary_example(spark):
    rows = [
        (1, 60000.0, "g", 0.5, False),
        (1, 60001.0, "r", 0.5, False),
        (1, 60002.0, "i", 0.5, True),
        (2, 60000.0, "g", 0.1, True),
        (None, 60000.0, "g", 0.1, True),
        (None, 60000.0, "g", 0.1, True),
    ]
    frame = spark.createDataFrame(
        rows,
        "dia_object_id long, mjd double, filter_name string, extendedness_median double, "
        "has_ss_source boolean",
    )
    (row,) = aggregates.source_summary(frame).collect()
    assert (row["detection_count"], row["time_span_days"], row["has_sso_detection"]) == (3, 2.0, True)
    assert row["filters"] == ["g", "i", "r"]


def test_time_and_flux(spark):
    row = (
        spark.sql("SELECT TIMESTAMP'2021-11-18 13:15:00' AS t, 0.0 AS m0, 5.0 AS m5")
        .select(
            X.timestamp_to_mjd("t").alias("mjd"),
            X.mjd_to_timestamp(X.timestamp_to_mjd("t")).alias("back"),
            X.jd_to_mjd(F.lit(2459537.0520833)).alias("jd"),
            X.mag_to_flux("m0").alias("f0"),
            X.mag_to_flux("m5").alias("f5"),
            X.stable_id(F.lit("abc")).alias("id"),
            X.times_1000_low64(F.lit(5).cast("long")).alias("small"),
        )
        .first()
    )
    assert row["back"] == datetime(2021, 11, 18, 13, 15)
    assert math.isclose(row["mjd"], 59536.552083333336)
    assert math.isclose(row["jd"], 59536.5520833)
    assert row["f0"] == 1.0 and math.isclose(row["f5"], 0.01)
    assert row["id"] == 648541476951500027 and row["small"] == 5000
    assert X.as_of_mjd(datetime(1970, 1, 2)) == 40588.0


def test_packet_defaults(spark):
    lines = [
        json.dumps({"alertId": 5, "diaSource": None, "ssObject": {}}),
        json.dumps(
            {
                "alertId": 6,
                "diaSource": {"diaSourceId": 9, "ra": 1.0, "decl": 2.0, "midPointTai": 3.0,
                              "filterName": " G ", "trailLength": 4.0, "pixelFlagsBad": False},
                "ssObject": {"ssObjectId": "S"},
            }
        ),
    ]
    frame = spark.createDataFrame([(x,) for x in lines], "value string").select(
        F.from_json("value", PACKET_SCHEMA).alias("p")
    ).select("p.*")
    first, second = packets.flatten_packet(frame).orderBy("alert_id").collect()
    assert (first["dia_source_id"], first["ra"], first["mjd"]) == (0, 0.0, 0.0)
    assert first["has_ss_source"] is False and first["trail_data"] == {}
    assert second["filter_name"] == "g" and second["has_ss_source"] is True
    assert second["trail_data"] == {"trailLength": 4.0}
    assert second["pixel_flags"] == {"pixelFlagsBad": False}


def test_wire_header(spark):
    framed = b"\x00" + (12345).to_bytes(4, "big") + b"xyz"
    rows = [(framed,), (b"\x01plain",), (b"\x00abcd",)]
    out = wire.split_header(spark.createDataFrame(rows, "value binary")).collect()
    assert [(r["schema_id"], bytes(r["payload"])) for r in out] == [
        (12345, b"xyz"),
        (None, b"\x01plain"),
        (None, b"\x00abcd"),
    ]


def test_missing_connectors_fail_clearly(spark):
    with pytest.raises(wire.MissingPackage):
        wire.require_avro(spark)
    with pytest.raises(wire.MissingPackage):
        wire.kafka_messages(spark, "localhost:1", "topic")


def test_portal_rows(spark):
    rows = [
        (10, "OBJ", 0.0, 0.0, 2459537.0520833, 9, 5.0, 0.1, 0.25, None, "null", "named"),
        (11, "OBJ", None, 0.0, 2459537.0, 1, 5.0, 0.1, 0.25, 1, "X", None),
    ]
    (row,) = portal.portal_to_alerts(spark.createDataFrame(rows, PORTAL_SCHEMA)).collect()
    assert (row["alert_id"], row["filter_name"], row["ss_object_id"]) == (10, "unknown", "named")
    assert row["has_ss_source"] is False
    assert math.isclose(row["ps_flux"], 0.01) and math.isclose(row["snr"], 10.0)
    assert row["extendedness_median"] == row["extendedness_max"] == 0.75


def test_locus_tags_give_association_without_id(spark):
    props = {f.name: None for f in LOCUS_SCHEMA["alerts"].dataType.elementType["properties"].dataType}
    alert = {"alert_id": "5", "mjd": 60000.0, "properties": props, "packet": None}
    rows = [
        {"locus_id": "a", "ra": 0.0, "dec": 1.0, "tags": ["NEO"], "alerts": [alert]},
        {"locus_id": "b", "ra": 0.0, "dec": 1.0, "tags": None, "alerts": []},
    ]
    loci = spark.createDataFrame(rows, LOCUS_SCHEMA)
    (row,) = locus.locus_latest(loci).collect()
    assert row["has_ss_source"] is True and row["ss_object_id"] is None
    assert (row["ra"], row["mjd"]) == (0.0, 60000.0)


def _image(values, bitpix=16):
    import numpy as np

    pixels = np.array(values)
    cards = [("SIMPLE", "T"), ("BITPIX", bitpix), ("NAXIS", pixels.ndim)]
    cards += [(f"NAXIS{i + 1}", n) for i, n in enumerate(pixels.shape[::-1])]
    head = "".join(f"{k:<8}= {v!s:>20}".ljust(80) for k, v in cards) + "END".ljust(80)
    kind = {16: ">i2", -32: ">f4"}[bitpix]
    return head.ljust(2880).encode() + pixels.astype(kind).tobytes()


def test_stamps(spark):
    science, template, difference = (
        _image([[5, 6], [7, 8]]),
        _image([[1, 1], [1, 1]]),
        _image([[4.0, 5.0], [6.0, 8.0]], -32),
    )
    rows = [(1, "science", gzip.compress(science)), (1, "template", template)]
    rows += [(1, "difference", difference), (2, "science", b"\x1f\x8bbroken"), (2, "template", None)]
    stamps = spark.createDataFrame(rows, "dia_source_id long, kind string, data binary")
    found = cutouts.classify_stamps(stamps, keep_data=True)
    assert [r["verdict"] for r in found.collect()] == ["valid"] * 3 + ["invalid", "absent"]
    (cmp,) = cutouts.compare_triplets(cutouts.triplets(found.where("verdict = 'valid'"))).collect()
    assert cmp["shape_match"] and cmp["residual_rms"] == 0.5 and cmp["diff_peak"] == 8.0
    stats = cutouts.pixel_statistics(stamps).where("kind = 'difference'").first()
    assert (stats["min"], stats["max"], stats["dtype"]) == (4.0, 8.0, "float32")
