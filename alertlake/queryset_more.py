"""Third part of the registered queries: day partitions, late and bounded streams, file trees."""

from __future__ import annotations

import math
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.fixture import Tables, with_ctes
from alertlake.operators import cutouts as C
from alertlake.operators import filters as f
from alertlake.operators import presets as P
from alertlake.operators import reassoc as R
from alertlake.operators import views as VW
from alertlake.plans import export as E
from alertlake.plans import ingest as I
from alertlake.plans import processors as PR
from alertlake.plans import reports as RP
from alertlake.plans import storage as SG
from alertlake.queryset import AS_OF_TIME, MOON, ROW, ROW_SQL, add, r6
from alertlake.queryset_io import _FLAG_SQL, _KINDS_SQL, _TRAIL_SQL, _as_alerts, _delivered, _flat, _framed, _to_parquet
from alertlake.session import scratch_path
from alertlake.sources import files as FS
from alertlake.sources import packets as PK
from alertlake.sources import registry
from alertlake.streaming import ingest as SI

WIDTHS = (60, 200)
#: MJD of AS_OF, which the windows below end at or are counted back from.
NOW = 52210.5


def _windows(alerts: DataFrame) -> dict[str, DataFrame]:
    return {
        "in_time_window": VW.in_time_window(alerts, 50500.0, 50600.0),
        "recent": VW.recent(alerts, 30, AS_OF_TIME),
        "time_window": P.time_window(50500.25, 50600.0).apply(alerts),
        "quick_filter": f.quick_filter(alerts, mjd_min=50500.0, mjd_max=50530.0, snr_min=20),
        "processor": PR.MinimoonCandidates().run(alerts, 50000.0, 50100.0),
        "newest": VW.processing_window(alerts, 15),
    }


def _wide_partitions(t: Tables) -> DataFrame:
    parts = []
    for width in WIDTHS:
        path = scratch_path(t.spark, f"days-{width}")
        SG.write_by_day(_as_alerts(t.alerts), path, partition_days=width)
        stored = SG.read_by_day(t.spark, path, width)
        for name, rows in _windows(stored).items():
            parts.append(rows.agg(F.count("*").alias("n")).select(F.lit(width).alias("width"), F.lit(name).alias("what"), "n"))
    return reduce(DataFrame.unionByName, parts)


add(
    "window_on_wide_partitions",
    _wide_partitions,
    with_ctes(
        "alerts",
        f"""SELECT CAST(width AS INTEGER) AS width, what, n FROM (SELECT unnest([60, 200]) AS width),
        (SELECT 'in_time_window' AS what, count(*) AS n FROM alerts WHERE mjd BETWEEN 50500 AND 50600
        UNION ALL SELECT 'recent', count(*) FROM alerts WHERE mjd >= {NOW} - 30
        UNION ALL SELECT 'time_window', count(*) FROM alerts WHERE mjd BETWEEN 50500.25 AND 50600
        UNION ALL SELECT 'quick_filter', count(*) FROM alerts WHERE mjd BETWEEN 50500 AND 50530 AND snr >= 20
        UNION ALL SELECT 'processor', count(*) FROM alerts WHERE mjd BETWEEN 50000 AND 50100
          AND {MOON} AND (snr IS NULL OR snr >= 5)
        UNION ALL SELECT 'newest', count(*) FROM alerts WHERE mjd >= (SELECT max(mjd) FROM alerts) - 15)""",
    ),
)


def _per_trigger(t: Tables, path: str, batches: int) -> int:
    """Files for each trigger, so that a folder is read in so many micro-batches. A part is one file only
    while it is small: one file at a time, the runs of a stream would be as many as the tasks that wrote it."""
    return max(1, math.ceil(len(SG.data_files(t.spark, path)) / batches))


def _as_files(t: Tables, rows: DataFrame, order: str, label: str) -> str:
    """Rows in three parts, those of the largest ``order`` first, as a stream source reads them."""
    path = scratch_path(t.spark, label)
    cuts = rows.approxQuantile(order, [0.33, 0.67], 0.01)
    bounds = [None, *sorted(cuts, reverse=True), None]
    for high, low in zip(bounds, bounds[1:]):
        part = rows
        part = part.where(F.col(order) <= high) if high is not None else part
        part = part.where(F.col(order) > low) if low is not None else part
        part.write.mode("append").parquet(path)
    return path


def _dedupe_late(t: Tables) -> DataFrame:
    rows = t.fx.select("alert_id", "dia_source_id", "mjd")
    path = _as_files(t, rows, "mjd", "late")
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _per_trigger(t, path, 3)).parquet(path)
    return _to_parquet(SI.dedupe_stream(stream), "late-deduped").select("alert_id", "dia_source_id")


add("stream_dedupe_late", _dedupe_late, with_ctes("fx", "SELECT DISTINCT alert_id, dia_source_id FROM fx"))


def _stream_bounded(t: Tables) -> DataFrame:
    rows = _as_alerts(t.fx)
    path = _as_files(t, rows, "mjd", "bounded")
    lake = SG.Lake(scratch_path(t.spark, "bounded-lake"), 400)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _per_trigger(t, path, 3)).parquet(path)
    SI.run_bounded(SI.start_ingest(stream, lake, scratch_path(t.spark, "bounded-offsets"), name="bounded"))
    return lake.read(t.spark, "alerts").select("alert_id", "dia_source_id")


add("stream_bounded", _stream_bounded, with_ctes("fx", "SELECT DISTINCT alert_id, dia_source_id FROM fx"))


def _maps_roundtrip(t: Tables) -> DataFrame:
    folder = E.export(PK.flatten_packet(t.packets), scratch_path(t.spark, "maps"), "csv")
    return _flat(FS.read_csv_alerts(t.spark, folder))


add(
    "csv_maps_roundtrip",
    _maps_roundtrip,
    with_ctes(
        "fx",
        f"""SELECT {ROW_SQL}, extendedness_max, ss_object_reassoc_time_mjd,
        {_TRAIL_SQL}, {_FLAG_SQL} FROM fx""",
    ),
)


def _tree(t: Tables, tree: str = "l_linenumber") -> DataFrame:
    """CSV files with and without a trail column, and tab-separated ones; rows are dealt by ``tree``, 1 to 4."""
    back = {v: k for k, v in FS.CSV_NAMES.items()}
    root = scratch_path(t.spark, "tree")
    wire = t.fx.select(*[F.col(c).alias(back.get(c, c)) for c in ROW], "l_linenumber", "l_quantity", "l_suppkey")
    for number, more in ((1, []), (2, [F.col("l_quantity").alias("trailLength")]), (3, [(F.col("l_suppkey") % 2 == 0).alias("pixelFlagsBad")])):
        part = wire.where(F.expr(tree) == number).select(*[back.get(c, c) for c in ROW], *more)
        E.export(part, f"{root}/csv/{number}", "csv")
    tabbed = wire.where(F.expr(tree) == 4).select(*[back.get(c, c) for c in ROW])
    tabbed.write.option("header", True).option("sep", "\t").format("csv").save(f"{root}/tabbed")
    return _renamed_tsv(t, root).select(*ROW, F.coalesce(F.get(F.map_values("trail_data"), 0), F.lit(0.0)).alias("trail"))


def _renamed_tsv(t: Tables, root: str) -> DataFrame:
    """Spark names part files .csv whatever the separator, so the tabbed folder is read by type."""
    tree = FS.read_alert_files(t.spark, f"{root}/csv")
    return tree.unionByName(FS.read_alert_files(t.spark, f"{root}/tabbed", "tsv"))


add(
    "file_tree_scan",
    _tree,
    with_ctes(
        "fx",
        f"""SELECT {ROW_SQL}, CASE WHEN l_linenumber = 2 THEN CAST(l_quantity AS DOUBLE) ELSE 0 END AS trail
        FROM fx WHERE l_linenumber <= 4""",
    ),
)
add(
    "file_tree_scan_all",
    lambda t: _tree(t, "(l_linenumber - 1) % 4 + 1"),
    with_ctes(
        "fx",
        f"""SELECT {ROW_SQL}, CASE WHEN l_linenumber % 4 = 2 THEN CAST(l_quantity AS DOUBLE) ELSE 0 END AS trail
        FROM fx""",
    ),
)


def _inventory(t: Tables) -> DataFrame:
    stamps = C.stamps_long(t.stamps).where("data IS NOT NULL").select(
        F.col("kind"), F.octet_length("data").cast("long").alias("length")
    )
    return C.inventory(stamps).select("kind", F.col("files").cast("bigint").alias("files"), "bytes")


add(
    "cutout_inventory",
    _inventory,
    with_ctes(
        "alerts",
        f"""{_KINDS_SQL} SELECT kind, count(*) AS files, CAST(sum(CASE WHEN kind = 'science' THEN
          CASE l_linenumber WHEN 4 THEN 2896 + 23 WHEN 5 THEN 0 WHEN 6 THEN 21 WHEN 7 THEN 4 ELSE 2896 END
        WHEN kind = 'difference' AND l_linenumber = 7 THEN 2880 ELSE 2896 END) AS BIGINT) AS bytes
        FROM s WHERE present GROUP BY kind""",
    ),
)


def _named_exports(t: Tables) -> DataFrame:
    folder, parts = scratch_path(t.spark, "named"), []
    for what in ("recent", "minimoon", "custom"):
        if what == "custom":
            VW.register_views(_as_alerts(t.alerts))
        path = E.named_export(
            what, t.alerts, folder, "parquet", as_of=AS_OF_TIME, days=60,
            sql="SELECT * FROM alerts_raw WHERE snr > ?", params=[50.0],
        )
        rows = t.spark.read.parquet(path)
        parts.append(rows.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n"))
    return reduce(DataFrame.unionByName, parts)


add(
    "named_exports",
    _named_exports,
    with_ctes(
        "alerts",
        f"""SELECT 'recent' AS what, count(*) AS n FROM alerts WHERE mjd >= {NOW} - 60
        UNION ALL SELECT 'minimoon', count(*) FROM alerts WHERE {MOON}
        UNION ALL SELECT 'custom', count(*) FROM alerts WHERE snr > 50""",
    ),
)


def _hot_source(t: Tables) -> DataFrame:
    """A third of all alerts share one source, whose rows many tasks share."""
    hot = F.when(F.col("alert_id") % 3 == 0, F.lit(1)).otherwise(F.col("dia_source_id"))
    return _detected(t, hot)


def _detected(t: Tables, hot: F.Column) -> DataFrame:
    rows = t.alerts.select(
        "alert_id", hot.cast("long").alias("dia_source_id"), "mjd", "ss_object_id", "ss_object_reassoc_time_mjd"
    )
    return R.detect_reassociations(rows, tasks=32).select(
        "alert_id", "dia_source_id", "is_reassociation", "is_new_source"
    )


add(
    "detect_hot_source",
    _hot_source,
    with_ctes(
        "alerts",
        """, h AS (SELECT alert_id, CASE WHEN alert_id % 3 = 0 THEN 1 ELSE dia_source_id END AS dia_source_id,
          mjd, ss_object_id AS id, ss_object_reassoc_time_mjd AS tm FROM alerts),
        p AS (SELECT *, row_number() OVER w AS nth, lag(id) OVER w AS pid, lag(tm) OVER w AS ptm
          FROM h WINDOW w AS (PARTITION BY dia_source_id ORDER BY mjd, alert_id))
        SELECT alert_id, dia_source_id, nth > 1 AND coalesce(CASE WHEN pid IS NULL AND id IS NOT NULL THEN true
          WHEN pid <> id THEN true WHEN ptm <> tm THEN true END, false) AS is_reassociation,
          nth = 1 AS is_new_source FROM p""",
    ),
)


add(
    "ordered_topk",
    lambda t: P.high_snr(20.0, limit=500)
    .apply(t.alerts)
    .select(F.monotonically_increasing_id().alias("position"), "alert_id", "dia_source_id", "snr"),
    with_ctes(
        "alerts",
        """SELECT row_number() OVER (ORDER BY snr DESC, alert_id, dia_source_id) - 1 AS position,
        alert_id, dia_source_id, snr FROM alerts WHERE snr >= 20 QUALIFY position < 500""",
    ),
)


def _message_ingest(t: Tables) -> DataFrame:
    """Framed messages as a stream of two parts; a row for what was stored and what was not decoded."""
    path = scratch_path(t.spark, "messages")
    messages = _framed(t)
    for part in (0, 1):
        messages.where(F.pmod(F.crc32("value"), F.lit(2)) == part).write.mode("append").parquet(path)
    stream = t.spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", _per_trigger(t, path, 2)).parquet(path)
    lake = SG.Lake(scratch_path(t.spark, "message-lake"), 400)
    SI.run_bounded(SI.start_message_ingest(stream, lake, scratch_path(t.spark, "message-offsets")))
    runs = I.latest_runs(t.spark, lake)
    stored = lake.read(t.spark, "alerts").select("alert_id").distinct().count()
    undecoded = t.spark.read.parquet(lake.path("undecoded")).count()
    return runs.agg(
        F.sum("alerts_received").alias("received"), F.sum("alerts_failed").alias("failed"), F.sum("alerts_ingested").alias("ingested")
    ).select("*", F.lit(stored).cast("bigint").alias("stored"), F.lit(undecoded).cast("bigint").alias("undecoded"))


add(
    "message_ingest",
    _message_ingest,
    with_ctes(
        "fx",
        """SELECT count(*) AS received, count(*) FILTER (l_linenumber = 5) AS failed,
        count(DISTINCT alert_id) FILTER (l_linenumber <> 5) AS ingested,
        count(DISTINCT alert_id) FILTER (l_linenumber <> 5) AS stored,
        count(*) FILTER (l_linenumber = 5) AS undecoded FROM fx""",
    ),
)
add(
    "detect_single_source",
    lambda t: _detected(t, F.lit(1)),
    with_ctes(
        "alerts",
        """, p AS (SELECT *, ss_object_id AS id, ss_object_reassoc_time_mjd AS tm, row_number() OVER w AS nth,
          lag(ss_object_id) OVER w AS pid, lag(ss_object_reassoc_time_mjd) OVER w AS ptm
          FROM alerts WINDOW w AS (ORDER BY mjd, alert_id))
        SELECT alert_id, CAST(1 AS BIGINT) AS dia_source_id, nth > 1 AND coalesce(
          CASE WHEN pid IS NULL AND id IS NOT NULL THEN true
          WHEN pid <> id THEN true WHEN ptm <> tm THEN true END, false) AS is_reassociation,
          nth = 1 AS is_new_source FROM p""",
    ),
)


# --- stored days, damaged files, files by date, readers by name, streams that go on ------------


def _sketched(t: Tables) -> DataFrame:
    """Months from the stored days alone, beside exact counts: whether each is within four standard errors."""
    days = scratch_path(t.spark, "days")
    RP.daily_sketches(t.alerts).write.parquet(days)
    months = RP.monthly_from_sketches(t.spark.read.parquet(days))
    exact = t.alerts.groupBy(F.year(RP.observing_date()).alias("year"), F.month(RP.observing_date()).alias("month")).agg(
        F.count_distinct("dia_object_id").alias("exact_objects"), F.count_distinct("dia_source_id").alias("exact_sources")
    )
    near = lambda c: F.abs(F.col(f"unique_{c}") - F.col(f"exact_{c}")) <= F.ceil(F.col(f"exact_{c}") * (4 * RP.SKETCH_ERROR))
    return months.join(exact, ["year", "month"]).select(
        "year", "month", "total_alerts", "exact_objects", "exact_sources",
        near("objects").alias("objects_near"), near("sources").alias("sources_near"),
    )


_MJD_DATE = "DATE '1858-11-17' + CAST(floor(mjd) AS INTEGER)"
add(
    "monthly_objects_sketch",
    _sketched,
    with_ctes(
        "alerts",
        f"""SELECT year({_MJD_DATE}) AS year, month({_MJD_DATE}) AS month, count(*) AS total_alerts,
        count(DISTINCT dia_object_id) AS exact_objects, count(DISTINCT dia_source_id) AS exact_sources,
        true AS objects_near, true AS sources_near FROM alerts GROUP BY 1, 2""",
    ),
)


def _damaged_lines(t: Tables) -> str:
    """Packets as JSON lines in two folders: line 5 is cut short, line 6 has no alert id, blank lines between."""
    folder = scratch_path(t.spark, "damaged")
    line = F.col("alertId") % 8
    text = F.to_json(F.struct("alertId", "diaSource", "ssObject"))
    bare = F.to_json(F.struct("diaSource", "ssObject"))
    lines = t.packets.select(
        F.when(line == 5, F.substring(text, F.lit(1), F.length(text) - 7))
        .when(line == 6, bare)
        .when(line == 7, F.concat(text, F.lit("\n")))
        .otherwise(text)
        .alias("value")
    )
    dealt = PK.with_verdict(lines, "part", F.when(F.length("value") % 2 == 0, "a").otherwise("b"))
    # Both folders in one pass, their files open side by side: rows need not be sorted by folder.
    side_by_side = "spark.sql.maxConcurrentOutputFileWriters"
    before = t.spark.conf.get(side_by_side)
    t.spark.conf.set(side_by_side, 2)
    try:
        dealt.write.partitionBy("part").text(folder, compression="snappy")
    finally:
        t.spark.conf.set(side_by_side, before)
    return folder


def _quarantined(t: Tables) -> DataFrame:
    folder = _damaged_lines(t)
    good, bad = FS.read_json_with_rejects(t.spark, [f"{folder}/part={x}" for x in "ab"])
    kept = good.agg(F.lit("alert").alias("what"), F.count(F.lit(1)).alias("n"))
    return kept.unionByName(bad.groupBy(F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n")))


add(
    "json_quarantine",
    _quarantined,
    with_ctes(
        "fx",
        """SELECT 'alert' AS what, count(*) FILTER (l_linenumber NOT IN (5, 6)) AS n FROM fx
        UNION ALL SELECT 'no JSON packet', count(*) FROM fx WHERE l_linenumber = 5
        UNION ALL SELECT 'no alert id', count(*) FROM fx WHERE l_linenumber = 6""",
    ),
)


def _damaged_run(t: Tables) -> DataFrame:
    lake, folder = SG.Lake(scratch_path(t.spark, "lake"), 400), _damaged_lines(t)
    I.ingest_json(t.spark, [f"{folder}/part={x}" for x in "ab"], lake, run_id="damaged")
    return I.latest_runs(t.spark, lake).select("run_id", "alerts_received", "alerts_failed", "alerts_ingested")


add(
    "ingest_damaged",
    _damaged_run,
    with_ctes(
        "fx",
        """SELECT 'damaged' AS run_id, count(*) AS alerts_received, count(*) FILTER (l_linenumber IN (5, 6))
        AS alerts_failed, count(DISTINCT alert_id) FILTER (l_linenumber NOT IN (5, 6)) AS alerts_ingested FROM fx""",
    ),
)


def _dated_files(t: Tables) -> str:
    """One CSV file for each month, named after its first day, with the columns' names in files."""
    folder, back = scratch_path(t.spark, "dated"), {v: k for k, v in FS.CSV_NAMES.items()}
    given = ("alert_id", "dia_source_id", "dia_object_id", "ra", "dec", "mjd", "filter_name", "ps_flux", "snr", "has_ss_source")
    month = F.date_format(F.trunc(RP.observing_date(), "month"), "yyyyMMdd")
    rows = t.alerts.select(month.alias("month"), *(F.col(c).alias(back.get(c, c)) for c in given))
    # All rows of a month in one file, which is what such files are; months go to tasks by hash.
    rows.repartition("month").write.partitionBy("month").option("header", True).csv(folder)
    for k, (path, *_) in enumerate(SG.data_files(t.spark, folder)):
        day = path.split("month=")[1][:8]
        fs, old = SG.hadoop_path(t.spark, path)
        fs.rename(old, SG.hadoop_path(t.spark, f"{path.rsplit('/', 1)[0]}/alerts_{day}.csv")[1])
    return folder


def _dated_report(t: Tables) -> DataFrame:
    """The daily report of the files of two years."""
    rows = FS.read_dated_alerts(t.spark, _dated_files(t), date(1994, 1, 1), date(1995, 12, 31))
    return RP.daily_report(rows).select(
        F.col("date").cast("string").alias("date"), "total_alerts", "unique_sources", "with_sssource",
        r6("flux_median").alias("flux_median"), r6("snr_median").alias("snr_median"),
    )


add(
    "dated_csv_report",
    _dated_report,
    with_ctes(
        "alerts",
        f"""SELECT CAST(CAST({_MJD_DATE} AS DATE) AS VARCHAR) AS date, count(*) AS total_alerts,
        count(DISTINCT dia_source_id) AS unique_sources, count(*) FILTER (has_ss_source) AS with_sssource,
        round(median(ps_flux) + 3.1e-9, 6) AS flux_median, round(median(snr) + 3.1e-9, 6) AS snr_median
        FROM alerts WHERE year({_MJD_DATE}) IN (1994, 1995) GROUP BY 1""",
    ),
)


def _by_name(t: Tables) -> DataFrame:
    """The packets through three registered readers, and a bounded read of each."""
    folder, parts = scratch_path(t.spark, "by-name"), []
    t.packets.write.parquet(f"{folder}/parquet")
    t.packets.write.json(f"{folder}/json", compression="gzip")
    E.export(PK.flatten_packet(t.packets), f"{folder}/csv", "csv", compression="gzip")
    for name in ("parquet", "json", "csv"):
        rows = registry.read(t.spark, name, f"{folder}/{name}")
        few = registry.read(t.spark, name, f"{folder}/{name}", limit=100).select(F.lit(None).cast("long").alias("alert_id"))
        both = rows.select("alert_id").unionByName(few)
        parts.append(
            both.agg(F.count("alert_id").alias("n"), F.count_distinct("alert_id").alias("ids"), F.count_if(F.col("alert_id").isNull()).alias("bounded"))
            .withColumn("source", F.lit(name))
        )
    return reduce(DataFrame.unionByName, parts)


add(
    "registered_readers",
    _by_name,
    with_ctes(
        "fx",
        """SELECT count(*) AS n, count(DISTINCT alert_id) AS ids, 100 AS bounded, source
        FROM fx, (SELECT unnest(['parquet', 'json', 'csv']) AS source) GROUP BY source""",
    ),
)


def _resumed(t: Tables) -> DataFrame:
    """A stream that ends, and goes on from its offsets when more files are there: runs by name."""
    rows, path = _delivered(t, _as_alerts(t.alerts), "given"), scratch_path(t.spark, "growing")
    lake, offsets = SG.Lake(scratch_path(t.spark, "resumed-lake"), 400), scratch_path(t.spark, "resumed")
    for part in ("mjd < 50000", "mjd >= 50000 AND mjd < 51000", "mjd >= 51000"):
        rows.where(part).write.mode("append").parquet(path)
        stream = t.spark.readStream.schema(rows.schema).parquet(path)
        SI.run_bounded(SI.start_ingest(stream, lake, offsets, name="part"))
    return I.latest_runs(t.spark, lake).select("run_id", "alerts_received", "alerts_ingested", "status")


add(
    "stream_resume",
    _resumed,
    with_ctes(
        "alerts",
        """SELECT 'part-' || CASE WHEN mjd < 50000 THEN 0 WHEN mjd < 51000 THEN 1 ELSE 2 END AS run_id,
        count(*) AS alerts_received, count(*) AS alerts_ingested, 'completed' AS status FROM alerts GROUP BY 1""",
    ),
)
