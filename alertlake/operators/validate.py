"""Range rules of the flat alert table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.functions import exprs as X

FAILED = "failed_rules"

# Rule name -> (column, lower bound, upper bound, bound excluded, required).
RANGES = {
    "ra": (0.0, 360.0, True),
    "dec": (-90.0, 90.0, True),
    "snr": (0.0, None, False),
    "extendedness_median": (0.0, 1.0, False),
    "extendedness_min": (0.0, 1.0, False),
    "extendedness_max": (0.0, 1.0, False),
}


def violations() -> dict[str, Column]:
    """Rule name -> column that is true where a row breaks the rule (never null)."""
    rules = {f"{c}_required": F.col(c).isNull() for c in ("alert_id", "dia_source_id")}
    for name, (low, high, required) in RANGES.items():
        value = F.col(name)
        ok = value >= low
        if high is not None:
            ok = ok & (value <= high)
        rules[f"{name}_range"] = ~F.coalesce(ok, F.lit(not required))
    rules["mjd_positive"] = ~F.coalesce(F.col("mjd") > 0, F.lit(False))
    return rules


def normalize_alerts(alerts: DataFrame) -> DataFrame:
    """Trim strings, lower-case the band, turn NaN into null."""
    changes = {}
    for field in alerts.schema.fields:
        kind = field.dataType.typeName()
        if field.name == "filter_name":
            changes[field.name] = X.clean_band(field.name)
        elif kind == "string":
            changes[field.name] = X.clean_text(field.name)
        elif kind == "double":
            changes[field.name] = X.nan_to_null(field.name)
    return alerts.withColumns(changes)


def annotate_violations(alerts: DataFrame) -> DataFrame:
    found = [F.when(broken, F.lit(name)) for name, broken in violations().items()]
    return alerts.withColumn(FAILED, F.array_compact(F.array(*found)))


def is_valid() -> Column:
    valid = F.lit(True)
    for broken in violations().values():
        valid = valid & ~broken
    return valid


def validate_alerts(alerts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the names of the broken rules). Narrow, no shuffle."""
    ok = is_valid()
    return alerts.where(ok), annotate_violations(alerts.where(~ok))
