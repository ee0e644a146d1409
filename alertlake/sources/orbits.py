"""Tables of orbital elements -> synthetic alerts, one per named object."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.functions import exprs as X
from alertlake.schema import ALERT_COLUMNS
from alertlake.sources.packets import complete

# Element columns (column names ignore case, so the aphelion distance Q has a
# name of its own), and what stands in for a measured extendedness.
ELEMENTS = ("a", "e", "inc", "arg", "node", "true_anomaly", "q", "q_aphelion")
EXTENDEDNESS = {"extendedness_min": 0.0, "extendedness_median": 0.1, "extendedness_max": 0.2}


def orbits_to_alerts(
    orbits: DataFrame,
    *,
    reference_plane: str = "ECLIPJ2000",
    origin: str = "sun",
    band: str = "orbit",
) -> DataFrame:
    """``name``, the elements and ``epoch_jd``. The elements stay in an ``orbit`` struct."""
    object_id = X.stable_id("name")
    placed = F.col("node").isNotNull() & F.col("inc").isNotNull()
    given = {
        "alert_id": object_id,
        "dia_source_id": X.times_1000_low64(object_id),
        "dia_object_id": object_id,
        "ra": F.when(placed, F.pmod("node", F.lit(360.0))).otherwise(0.0),
        "dec": F.when(placed, X.clamp(F.col("inc") - 90, -90.0, 90.0)).otherwise(0.0),
        "mjd": X.jd_to_mjd("epoch_jd"),
        "filter_name": F.lit(band),
        "has_ss_source": F.lit(True),
        "ss_object_id": F.col("name"),
        **{c: F.lit(v) for c, v in EXTENDEDNESS.items()},
    }
    orbit = F.struct(
        *[F.col(c).cast("double").alias(c) for c in ELEMENTS if c in orbits.columns],
        F.lit(reference_plane).alias("reference_plane"),
        F.lit(origin).alias("origin"),
    )
    return orbits.select(
        *[complete(given, n).alias(n) for n in ALERT_COLUMNS], orbit.alias("orbit")
    )
