"""Alert-shaped views over the benchmark tables, in SQL text both engines read.

The given tables hold no alerts, so rows of ``lineitem`` stand for them. Everything here
scales with that table. ``*_SQL`` are CTE bodies; ``with_ctes`` strings them together.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.operators.dedupe import dedupe_alerts
from alertlake.operators.reassoc import detect_reassociations
from alertlake.schema import LOCUS_PROPERTIES, SS_OBJECT

AS_OF = "2001-10-28 12:00:00"  # fixed instant for time-relative queries

_SPARK_DAY = "datediff(CAST(l_shipdate AS DATE), DATE'1858-11-17')"
_DUCK_DAY = "date_diff('day', DATE '1858-11-17', CAST(l_shipdate AS DATE))"

FX_BODY = """
SELECT l_orderkey*8 + l_linenumber AS alert_id,
 l_orderkey AS dia_source_id,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey END AS dia_object_id,
 CAST((l_partkey*37) % 3600 AS DOUBLE)/10 AS ra,
 CAST((l_suppkey*53) % 1800 AS DOUBLE)/10 - 90 AS dec,
 CAST({DAY} AS DOUBLE) + CAST(l_linenumber AS DOUBLE)/8 AS mjd,
 CAST(l_shipdate AS TIMESTAMP) AS ingested_at,
 CASE l_linenumber WHEN 1 THEN 'u' WHEN 2 THEN 'g' WHEN 3 THEN 'r' WHEN 4 THEN 'i'
      WHEN 5 THEN 'z' WHEN 6 THEN 'y' END AS filter_name,
 l_extendedprice AS ps_flux,
 l_extendedprice/l_quantity AS ps_flux_err,
 l_extendedprice/1000 AS snr,
 CASE WHEN l_tax >= 0.08 THEN NULL ELSE l_quantity/50 END AS extendedness_median,
 CASE WHEN l_tax >= 0.08 THEN NULL ELSE l_quantity/50*0.9 END AS extendedness_min,
 CASE WHEN l_tax >= 0.08 THEN NULL ELSE (l_quantity/50 + 1)/2 END AS extendedness_max,
 l_returnflag <> 'N' AS has_ss_source,
 CASE WHEN l_returnflag = 'N' THEN NULL
      ELSE concat('SSO_', CAST(l_suppkey % 5 AS STRING)) END AS ss_object_id,
 CASE WHEN l_returnflag = 'R' THEN CAST({DAY} AS DOUBLE) + CAST(l_linenumber AS DOUBLE)/8
      - CAST(l_partkey % 4 AS DOUBLE)/2 END AS ss_object_reassoc_time_mjd,
 l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag
FROM {LINEITEM}
"""

DEDUPE_ORDER = ("mjd", "l_partkey", "l_suppkey", "l_quantity", "ps_flux")

CTES = {
    "fx": FX_BODY.format(DAY=_DUCK_DAY, LINEITEM="lineitem"),
    "alerts": f"""
SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (
   PARTITION BY alert_id, dia_source_id ORDER BY {", ".join(DEDUPE_ORDER)}) AS _rn FROM fx)
WHERE _rn = 1""",
    "lagged": """
SELECT *, row_number() OVER w AS _nth, lag(ss_object_id) OVER w AS _pid,
 lag(ss_object_reassoc_time_mjd) OVER w AS _ptime
FROM alerts WINDOW w AS (PARTITION BY dia_source_id ORDER BY mjd, alert_id)""",
    "reasoned": """
SELECT *, CASE WHEN _nth = 1 THEN NULL
 WHEN _pid IS NULL AND ss_object_id IS NOT NULL THEN 'new_association'
 WHEN _pid <> ss_object_id THEN 'changed_association'
 WHEN _ptime <> ss_object_reassoc_time_mjd THEN 'updated_reassociation' END
 AS reassociation_reason FROM lagged""",
    "flagged": """
SELECT * EXCLUDE (_nth, _pid, _ptime), reassociation_reason IS NOT NULL AS is_reassociation,
 _nth = 1 AS is_new_source FROM reasoned""",
}


def with_ctes(upto: str, select: str) -> str:
    """``select`` over the CTEs up to and including ``upto``."""
    parts = []
    for name, body in CTES.items():
        parts.append(f"{name} AS ({body.strip()})")
        if name == upto:
            break
    return f"WITH {', '.join(parts)} {select.strip()}".replace(") , ", "), ")


class Tables:
    """The views as DataFrames over ``<sf_dir>/*.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def derive(self, lineitem: DataFrame) -> DataFrame:
        text = FX_BODY.format(DAY=_SPARK_DAY, LINEITEM="{lineitem}")
        return self.spark.sql(text, lineitem=lineitem)

    @cached_property
    def fx(self) -> DataFrame:
        """Raw alerts with natural duplicates."""
        return self.derive(self.table("lineitem"))

    @cached_property
    def alerts(self) -> DataFrame:
        return dedupe_alerts(self.fx, DEDUPE_ORDER)

    @cached_property
    def flagged(self) -> DataFrame:
        return detect_reassociations(self.alerts, probe=self.fx)

    @cached_property
    def packets(self) -> DataFrame:
        """Nested packets of the raw rows; bands are padded and in upper case."""
        f = F.col
        even = f("l_linenumber") % 2 == 0
        source = F.struct(
            f("dia_source_id").alias("diaSourceId"),
            f("dia_object_id").alias("diaObjectId"),
            "ra",
            f("dec").alias("decl"),
            f("mjd").alias("midPointTai"),
            F.concat(F.lit(" "), F.upper("filter_name"), F.lit(" ")).alias("filterName"),
            f("ps_flux").alias("psFlux"),
            f("ps_flux_err").alias("psFluxErr"),
            "snr",
            f("extendedness_median").alias("extendednessMedian"),
            f("extendedness_min").alias("extendednessMin"),
            f("extendedness_max").alias("extendednessMax"),
            F.when(even, f("l_quantity")).alias("trailLength"),
            F.when(f("l_returnflag") == "R", f("l_partkey") % 360).cast("double").alias("trailAngle"),
            F.lit(None).cast("double").alias("trailWidth"),
            (f("l_suppkey") % 2 == 0).alias("pixelFlagsBad"),
            F.when(even, f("l_partkey") % 3 == 0).alias("pixelFlagsCr"),
            F.lit(None).cast("boolean").alias("pixelFlagsEdge"),
            F.lit(False).alias("pixelFlagsSaturated"),
        )
        sso = F.struct(
            f("ss_object_id").alias("ssObjectId"),
            f("ss_object_reassoc_time_mjd").alias("ssObjectReassocTimeMjdTai"),
        )
        return self.fx.select(
            f("alert_id").alias("alertId"),
            source.alias("diaSource"),
            F.when(f("has_ss_source"), sso).alias("ssObject"),
        )

    @cached_property
    def portal_json(self) -> DataFrame:
        """Portal rows as JSON text (column ``value``)."""
        f = F.col
        fields = {
            "i:candid": F.when((f("l_linenumber") < 7) | (f("l_tax") < 0.08), f("alert_id")),
            "i:objectId": F.concat(F.lit("OBJ"), f("l_partkey").cast("string")),
            "i:ra": f("ra"),
            "i:dec": f("dec"),
            "i:jd": f("mjd") + 2400000.5,
            "i:fid": f("l_linenumber"),
            "i:magpsf": F.when(f("l_tax") < 0.08, f("l_quantity") / 10 + 15),
            "i:sigmapsf": f("l_discount"),
            "i:classtar": f("extendedness_median"),
            "d:roid": F.when(f("l_returnflag") == "R", F.lit(3)).when(
                f("l_returnflag") == "A", F.lit(0)
            ),
            "i:ssnamenr": F.when(f("l_returnflag") == "R", F.lit("null")).otherwise(
                f("ss_object_id")
            ),
            "sso_name": F.when(f("l_linenumber") % 2 == 0, F.lit("named")),
        }
        record = F.struct(*[c.alias(n) for n, c in fields.items()])
        return self.fx.select(F.to_json(record).alias("value"))

    @cached_property
    def loci(self) -> DataFrame:
        """One locus per raw row, with ``l_linenumber - 1`` alerts in its history."""
        f = F.col

        def history(i):
            at = f("mjd") + i.cast("double") / 4
            known = f("l_partkey") % 3
            own = {
                "diaSourceId": f("dia_source_id"),
                "diaObjectId": f("dia_object_id"),
                "ra": F.when(i % 2 == 0, f("ra")),
                "decl": F.when(i % 2 == 0, f("dec")),
                "midPointTai": F.when(i % 3 != 0, at + 0.5),
                "filterName": f("filter_name"),
                "psFlux": f("ps_flux"),
                "snr": f("snr"),
                "extendednessMedian": f("extendedness_median"),
                "extendednessMin": f("extendedness_min"),
                "extendednessMax": f("extendedness_max"),
                "ssObjectId": F.when(known == 0, f("ss_object_id")),
                "ssObjectReassocTimeMjdTai": F.when(
                    known == 0, f("ss_object_reassoc_time_mjd")
                ),
            }
            props = F.struct(
                *[
                    own.get(x.name, F.lit(None)).cast(x.dataType).alias(x.name)
                    for x in LOCUS_PROPERTIES.fields
                ]
            )
            sso = F.struct(
                f("ss_object_id").alias("ssObjectId"),
                f("ss_object_reassoc_time_mjd").alias("ssObjectReassocTimeMjdTai"),
            ).cast(SS_OBJECT)
            packet = F.struct(F.when(known == 1, sso).alias("ssObject"))
            return F.struct(
                (f("alert_id") * 8 + i).cast("string").alias("alert_id"),
                at.alias("mjd"),
                props.alias("properties"),
                packet.alias("packet"),
            )

        tags = F.when(f("l_suppkey") % 4 == 0, F.array(F.lit("SSO"), F.lit("x"))).when(
            f("l_suppkey") % 4 == 1, F.array(F.lit("comet"))
        )
        upto = f("l_linenumber") - 1
        # Line numbers are 1 to 7, so a history has six alerts at most: plain columns, no lambda.
        alerts = F.slice(F.array(*[history(F.lit(i)) for i in range(1, 7)]), F.lit(1), upto)
        return self.fx.select(
            f("alert_id").cast("string").alias("locus_id"),
            (f("ra") / 2).alias("locus_ra"),
            (f("dec") / 2).alias("locus_dec"),
            tags.alias("tags"),
            alerts.alias("alerts"),
        ).withColumnsRenamed({"locus_ra": "ra", "locus_dec": "dec"})

    @cached_property
    def stamps(self) -> DataFrame:
        """Deduplicated alerts with three image stamps of 4x4 bytes, the pixels being the
        md5 of ``<alert_id>-<kind>``. Science stamps also come gzipped (line 4), empty (5),
        as junk (6) and as broken gzip (7); difference stamps of line 7 declare no image."""
        f = F.col

        def image(kind: str):
            pixels = F.md5(F.concat(f("alert_id").cast("string"), F.lit(f"-{kind}")).cast("binary"))
            return F.concat(F.lit(_header(2)), F.unhex(pixels))

        def zipped(data):
            # gzip member with one stored block, put together from its parts
            crc = F.lpad(F.hex(F.crc32(data)), 8, "0")
            low_first = F.concat(*[F.substring(crc, i, 2) for i in (7, 5, 3, 1)])
            size = (2880 + 16).to_bytes(2, "little")
            inverse = (0xFFFF - 2880 - 16).to_bytes(2, "little")
            head = bytes.fromhex("1f8b0800000000000003") + b"\x01" + size + inverse
            return F.concat(F.lit(head), data, F.unhex(low_first), F.lit(size + b"\0\0"))

        line, present = f("l_linenumber"), f("l_tax") < 0.08
        science = (
            F.when(line == 4, zipped(image("science")))
            .when(line == 5, F.lit(b""))
            .when(line == 6, F.lit(b"junk that is no image"))
            .when(line == 7, F.lit(bytes.fromhex("1f8b0000")))
            .otherwise(image("science"))
        )
        difference = F.when(line == 7, F.lit(_header(0))).otherwise(image("difference"))
        return self.alerts.select(
            "alert_id",
            "dia_source_id",
            "dia_object_id",
            "mjd",
            F.when(present, science).alias("cutoutScience"),
            F.when(present, image("template")).alias("cutoutTemplate"),
            F.when(present, difference).alias("cutoutDifference"),
        )


def _header(axes: int) -> bytes:
    """A one-block image header for 4x4 unsigned bytes, or for no image."""
    cards = {"SIMPLE": "T", "BITPIX": "8", "NAXIS": str(axes)}
    cards |= {f"NAXIS{i + 1}": "4" for i in range(axes)}
    text = "".join(f"{k:<8}= {v:>20}".ljust(80) for k, v in cards.items()) + "END".ljust(80)
    return text.ljust(2880).encode()
