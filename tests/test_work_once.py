"""Costly steps are done once for each row: parsing, stacked images, calls for a key."""

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from alertlake import queryset_more
from alertlake.operators import cutouts
from alertlake.plans import processors, storage
from alertlake.schema import PACKET_SCHEMA
from alertlake.session import scratch_path
from alertlake.sources import files, wire


def _optimized(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def _packet(n):
    return json.dumps({"alertId": n, "diaSource": {"diaSourceId": n * 10, "ra": 1.0, "decl": 2.0, "midPointTai": 6e4}})


def test_messages_are_parsed_once_by_each_schema(spark):
    bodies = [(7, _packet(1)), (8, _packet(2)), (8, '{"alertId": 1, "dia'), (7, None)]
    rows = [(None if b is None else bytearray(b"\0" + k.to_bytes(4, "big") + b.encode()),) for k, b in bodies]
    messages = spark.createDataFrame(rows, "value binary").repartition(2)
    good, bad = wire.decode_messages(messages, by_schema_id={8: PACKET_SCHEMA})
    assert sorted(r.alert_id for r in good.collect()) == [1, 2]
    assert sorted((r.schema_id or 0, r.value is None) for r in bad.collect()) == [(0, True), (8, False)]
    assert _optimized(good).count("from_json") == 2 and _optimized(bad).count("from_json") == 2


def test_json_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([_packet(1), "", '{"alertId": 1, "di', '{"diaSource": {"diaSourceId": 3}}']))
    good, bad = files.read_json_with_rejects(spark, str(tmp_path))
    assert [r.alert_id for r in good.collect()] == [1]
    assert sorted(r.reason for r in bad.collect()) == ["no JSON packet", "no alert id"]
    assert _optimized(good).count("from_json") == 1 and _optimized(bad).count("from_json") == 1


def test_csv_values_are_typed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "alertId,diaSourceId,ra,decl,midPointTai,psFlux,filterName,trailLength\n"
        "1,12.0, 1.5 ,2.0,60000.5,NaN, G ,3.5\n2,1,1.0,2.0,60000.5,bad,g,\n3,1,,2.0,60000.5,1,g,\n"
    )
    rows = files.read_csv_alerts(spark, str(tmp_path))
    (got,) = rows.collect()
    assert (got.alert_id, got.dia_source_id, got.ra, got.ps_flux, got.filter_name) == (1, 12, 1.5, None, "g")
    assert got.trail_data == {"trailLength": 3.5}
    lines = _optimized(rows).split("\n")
    assert not any("Filter" in line and "try_cast" in line for line in lines)


def _stamp(bits, pixels, **cards):
    cards = {"SIMPLE": "T", "BITPIX": bits, "NAXIS": 2, "NAXIS1": pixels.shape[1], "NAXIS2": pixels.shape[0]} | cards
    text = "".join(f"{k:<8}= {v:>20}".ljust(80) for k, v in cards.items()) + "END".ljust(80)
    return text.ljust(2880).encode() + pixels.tobytes()


def test_stamps_of_one_layout_are_looked_at_together(spark, monkeypatch):
    import gzip

    r = np.random.default_rng(3)
    small = [r.integers(0, 255, (4, 4)).astype(">u1") for _ in range(50)]
    scaled = [r.normal(size=(3, 5)).astype(">f4") for _ in range(20)]
    scaled[3][1, 1], scaled[4][0, 0] = np.inf, np.nan
    images = [*small, *(x * 2.0 + 1.0 for x in scaled)]
    stamps = [_stamp(8, x) for x in small] + [_stamp(-32, x, BSCALE=2.0, BZERO=1.0) for x in scaled]
    stamps[7] = gzip.compress(stamps[7])
    odd = [None, b"", b"junk", stamps[0][:-1], b"\x1f\x8b\0"]
    calls, median = [], np.median
    monkeypatch.setattr(np, "median", lambda *a, **k: calls.append(1) or median(*a, **k))
    found = cutouts._stats_array([*odd, *stamps]).to_pylist()
    monkeypatch.undo()
    assert len(calls) == 2
    assert [x["verdict"] for x in found[:5]] == ["empty", "empty", "corrupt", "corrupt", "corrupt"]
    for x, image in zip(found[5:], images):
        values = image.astype("f8")
        wanted = [float(fn(values)) for fn in (np.min, np.max, np.mean, np.median, np.std)]
        got = [x[c] for c in ("min", "max", "mean", "median", "std")]
        assert got == [None if np.isnan(v) else v for v in wanted]
        assert (x["verdict"], x["shape"], x["dtype"]) == ("valid", "x".join(map(str, image.shape)), image.dtype.newbyteorder("=").name)
        assert (x["has_nan"], x["has_inf"]) == (np.isnan(values).any(), np.isinf(values).any())
    rows = spark.createDataFrame([(i, bytearray(s)) for i, s in enumerate(stamps)], "id int, data binary")
    assert cutouts.pixel_statistics(rows).where("verdict = 'valid' AND shape = '4x4'").count() == 50


def test_triplets_of_differing_types_are_compared(spark):
    a, b, c = (np.full((2, 2), v) for v in (7, 2, 4))
    c[0, 0] = 9
    rows = [
        (1, _stamp(16, a.astype(">i2")), _stamp(-64, b.astype(">f8")), _stamp(8, c.astype(">u1"))),
        (2, _stamp(8, a.astype(">u1")), _stamp(8, b.astype(">u1")), _stamp(8, np.zeros((2, 3), ">u1"))),
        (3, _stamp(8, a.astype(">u1")), b"junk", _stamp(8, c.astype(">u1"))),
        (4, _stamp(8, a.astype(">u1")), _stamp(8, b.astype(">u1")), _stamp(8, a.astype(">u1"))),
    ]
    packets = spark.createDataFrame(
        [(k, k, k, 6e4, *map(bytearray, x)) for k, *x in rows],
        "alert_id long, dia_source_id long, dia_object_id long, mjd double, cutoutScience binary,"
        "cutoutTemplate binary, cutoutDifference binary",
    )
    got = {r.alert_id: r for r in cutouts.compare_packets(packets).collect()}
    assert sorted(got) == [1, 2, 4]
    assert (got[1].shape, got[1].diff_peak) == ("2x2", 9.0)
    assert got[1].residual_rms == np.sqrt(np.mean((a - b - c) ** 2.0)) and got[1].diff_snr == 9 / c.std()
    assert (got[2].shape_match, got[2].shape) == (False, None)
    assert got[4].shape_match and got[4].diff_snr is None


class Calls(processors.GroupProcessor):
    """Rows of a key, and the calls that they took; the id beside the key is above 2**53 or null."""

    partial_schema = "dia_object_id long, n long, calls long"
    result_schema = "dia_object_id long, n long, calls long, big long"

    @staticmethod
    def partial(key, group):
        return pd.DataFrame({"dia_object_id": [key], "n": [len(group)], "calls": [1]})

    @staticmethod
    def merge(key, parts):
        return pd.DataFrame({"dia_object_id": [key], "n": [parts["n"].sum()], "calls": [parts["calls"].sum()]})

    @staticmethod
    def combine(key, parts):
        big = 2**53 + 1 if key % 2 else None
        return {"dia_object_id": key, "n": parts["n"].sum(), "calls": parts["calls"].sum(), "big": big} if key else None


def test_a_key_takes_one_call_unless_it_is_long(spark):
    hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 100)
    rows = spark.range(0, 30000, 1, 8).select(hot.alias("dia_object_id"), F.lit(5e4).alias("mjd"))
    got = {r.dia_object_id: r for r in Calls().run(rows, 0.0, 1e6).collect()}
    assert set(got) == {-1, *range(1, 100)} and got[-1].n == 10000
    assert all(got[k].n == 200 for k in range(1, 100))
    # Four tasks share the rows: a short key is in one place, or in two at the end of a range.
    assert sum(got[k].calls for k in range(1, 100)) <= 99 + 4
    assert got[1].big == got[-1].big == 2**53 + 1 and got[2].big is None
    assert Calls().run(rows.where("mjd < 0"), 0.0, 1e6).count() == 0


def test_texts_of_large_inputs_are_compressed(spark, tables):
    damaged = storage.data_files(spark, queryset_more._damaged_lines(tables))
    assert damaged and all(path.endswith(".snappy") for path, *_ in damaged)
    folder = queryset_more.E.export(tables.alerts.select("alert_id"), scratch_path(spark, "text"), "csv", compression="gzip")
    assert all(path.endswith(".csv.gz") for path, *_ in storage.data_files(spark, folder))
