"""Filter algebra: rules -> one Column, so that Catalyst pushes them into the scan."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.functions import sky
from alertlake.schema import ALERT_KEY


def _members(values: Any) -> list[Any]:
    if not isinstance(values, (list, tuple)):
        raise ValueError(f"a list is needed for membership tests, not {type(values).__name__}")
    return list(values)


# Operator text (as stored in saved filters) -> Column builder.
OPERATORS: dict[str, Callable[[Column, Any, Any], Column]] = {
    "=": lambda c, v, _: c == v,
    "!=": lambda c, v, _: c != v,
    "<": lambda c, v, _: c < v,
    "<=": lambda c, v, _: c <= v,
    ">": lambda c, v, _: c > v,
    ">=": lambda c, v, _: c >= v,
    "IN": lambda c, v, _: c.isin(_members(v)),
    "NOT IN": lambda c, v, _: ~c.isin(_members(v)),
    "LIKE": lambda c, v, _: c.ilike(v),  # the reference dialect ignores ASCII case
    "IS NULL": lambda c, *_: c.isNull(),
    "IS NOT NULL": lambda c, *_: c.isNotNull(),
    "BETWEEN": lambda c, low, high: c.between(low, high),
}


@dataclass(frozen=True)
class Rule:
    """One test on one column."""

    field: str
    operator: str
    value: Any = None
    value2: Any = None

    def __post_init__(self) -> None:
        if self.operator not in OPERATORS:
            raise ValueError(f"unknown operator {self.operator!r}; known: {', '.join(OPERATORS)}")

    def column(self, schema: T.StructType | None = None) -> Column:
        value, upper = self.value, self.value2
        if schema is not None and self.field in schema.fieldNames():
            if isinstance(schema[self.field].dataType, T.BooleanType):
                value, upper = _as_flag(value), _as_flag(upper)
        return OPERATORS[self.operator](F.col(self.field), value, upper)


def _as_flag(value: Any) -> Any:
    """Flags may be given as 0/1."""
    if isinstance(value, (list, tuple)):
        return [_as_flag(v) for v in value]
    return bool(value) if isinstance(value, int) else value


def eq(name: str, value: Any) -> Rule:
    return Rule(name, "=", value)


def ne(name: str, value: Any) -> Rule:
    return Rule(name, "!=", value)


def lt(name: str, value: Any) -> Rule:
    return Rule(name, "<", value)


def le(name: str, value: Any) -> Rule:
    return Rule(name, "<=", value)


def gt(name: str, value: Any) -> Rule:
    return Rule(name, ">", value)


def ge(name: str, value: Any) -> Rule:
    return Rule(name, ">=", value)


def in_list(name: str, values: Sequence[Any]) -> Rule:
    return Rule(name, "IN", values)


def not_in_list(name: str, values: Sequence[Any]) -> Rule:
    return Rule(name, "NOT IN", values)


def like(name: str, pattern: str) -> Rule:
    return Rule(name, "LIKE", pattern)


def is_null(name: str) -> Rule:
    return Rule(name, "IS NULL")


def is_not_null(name: str) -> Rule:
    return Rule(name, "IS NOT NULL")


def between(name: str, low: Any, high: Any) -> Rule:
    return Rule(name, "BETWEEN", low, high)


@dataclass(frozen=True)
class FilterConfig:
    """Rules joined by AND or OR, with an optional order and limit (0/None: no limit)."""

    name: str = "custom"
    description: str = ""
    conditions: tuple[Rule, ...] = field(default_factory=tuple)
    combine_with: str = "AND"
    order_by: str | None = None
    order_desc: bool = True
    limit: int | None = None

    def add(self, *rules: Rule) -> FilterConfig:
        return replace(self, conditions=(*self.conditions, *rules))

    def column(self, schema: T.StructType | None = None) -> Column:
        """The predicate; true for every row when there are no rules."""
        mode = self.combine_with.upper()
        if mode not in ("AND", "OR"):
            raise ValueError(f"combine_with is AND or OR, not {self.combine_with!r}")
        tests = [rule.column(schema) for rule in self.conditions]
        if not tests:
            return F.lit(True)
        return reduce(Column.__and__ if mode == "AND" else Column.__or__, tests)

    def apply(self, alerts: DataFrame, *, ordered: bool = True) -> DataFrame:
        """Matching rows. Order plus limit becomes a distributed top-k, not a full sort."""
        out = alerts.where(self.column(alerts.schema)) if self.conditions else alerts
        out = _bound_days(out, *self._range("mjd"))
        if sky.CELL in out.columns:
            out = _bound_cells(out, self._range("ra"), self._range("dec"))
        if self.order_by and (ordered or self.limit):
            lead = F.col(self.order_by)
            # The key breaks ties: results repeat, and equal values can be split
            # over several sort partitions.
            ties = [k for k in ALERT_KEY if k in alerts.columns and k != self.order_by]
            out = out.orderBy(lead.desc() if self.order_desc else lead.asc(), *ties)
        return out.limit(self.limit) if self.limit else out

    def _range(self, name: str) -> tuple[float | None, float | None]:
        """What rules that all have to hold leave of a column."""
        lows: list[float] = []
        highs: list[float] = []
        joined = self.combine_with.upper() == "AND" or len(self.conditions) == 1
        for rule in self.conditions if joined else ():
            value, upper = rule.value, rule.value2
            if rule.field == name and isinstance(value, (int, float)):
                if rule.operator in (">", ">=", "=", "BETWEEN"):
                    lows.append(value)
                if rule.operator in ("<", "<=", "="):
                    highs.append(value)
                elif rule.operator == "BETWEEN" and isinstance(upper, (int, float)):
                    highs.append(upper)
        return max(lows, default=None), min(highs, default=None)

    def to_dict(self) -> dict[str, Any]:
        rules = [
            {"field": r.field, "operator": r.operator, "value": r.value, "value2": r.value2}
            for r in self.conditions
        ]
        return {**self.__dict__, "conditions": rules}

    @classmethod
    def from_dict(cls, data: dict[str, Any]) -> FilterConfig:
        known = {k: v for k, v in data.items() if k in cls.__dataclass_fields__}
        known["conditions"] = tuple(
            Rule(r["field"], r["operator"], r.get("value"), r.get("value2"))
            for r in data.get("conditions", [])
        )
        return cls(**known)

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> FilterConfig:
        return cls.from_dict(json.loads(text))

    def config_hash(self) -> str:
        return hashlib.md5(self.to_json().encode()).hexdigest()[:16]


# keyword -> rule builder; every given keyword adds one rule.
_QUICK: dict[str, Callable[[Any], Rule]] = {
    "extendedness_min": lambda v: ge("extendedness_median", v),
    "extendedness_max": lambda v: le("extendedness_median", v),
    "snr_min": lambda v: ge("snr", v),
    "snr_max": lambda v: le("snr", v),
    "has_sso": lambda v: eq("has_ss_source", bool(v)),
    "exclude_sso": lambda v: eq("has_ss_source", False) if v else is_not_null("alert_id"),
    "is_reassociation": lambda v: eq("is_reassociation", bool(v)),
    "filter_name": lambda v: eq("filter_name", v),
    "filters": lambda v: in_list("filter_name", v),
    "mjd_min": lambda v: ge("mjd", v),
    "mjd_max": lambda v: le("mjd", v),
    "ra_min": lambda v: ge("ra", v),
    "ra_max": lambda v: le("ra", v),
    "dec_min": lambda v: ge("dec", v),
    "dec_max": lambda v: le("dec", v),
}


def quick_config(*, limit: int | None = None, **given: Any) -> FilterConfig:
    unknown = set(given) - set(_QUICK)
    if unknown:
        raise TypeError(f"unknown filter arguments: {', '.join(sorted(unknown))}")
    rules = [_QUICK[k](v) for k, v in given.items() if v is not None]
    return FilterConfig(name="quick_filter", conditions=tuple(rules), limit=limit)


def quick_filter(alerts: DataFrame, *, limit: int | None = None, **given: Any) -> DataFrame:
    return quick_config(limit=limit, **given).apply(alerts)


def filter_rows(
    alerts: DataFrame, test: Column | Callable[[dict], bool]
) -> DataFrame:
    """Arbitrary predicate: a Column, or as a fallback a Python function of the row dict, which
    workers apply to Arrow batches."""
    if isinstance(test, Column):
        return alerts.where(test)

    @F.arrow_udf(T.BooleanType())
    def holds(rows: pa.Array) -> pa.Array:
        return pa.array([bool(test(r)) for r in rows.to_pylist(maps_as_pydicts="lossy")], pa.bool_())

    return alerts.where(holds(F.struct("*")))


DAY, DAY_WIDTH = "mjd_day", "partition_days"


def with_day_width(alerts: DataFrame, partition_days: int) -> DataFrame:
    """Note on the column ``mjd_day`` how many days a partition spans, for ``prune_days``."""
    return alerts.withMetadata(DAY, {DAY_WIDTH: int(partition_days)})


def day_width(alerts: DataFrame) -> int | None:
    """Days of a partition; None where that is not noted or there is no such column."""
    if DAY not in alerts.columns:
        return None
    return (alerts.schema[DAY].metadata or {}).get(DAY_WIDTH)


def _bound_cells(alerts: DataFrame, ra: tuple, dec: tuple) -> DataFrame:
    """Skip the sky cells outside of the ranges; open sides reach to the end of the sky."""
    if (*ra, *dec) == (None,) * 4:
        return alerts
    either = lambda x, y: y if x is None else x
    box = (either(ra[0], 0.0), either(ra[1], 360.0), either(dec[0], -90.0), either(dec[1], 90.0))
    return alerts.where(sky.in_cells(sky.cells_of_box(*box)))


def _bound_days(alerts: DataFrame, start: float | None, end: float | None) -> DataFrame:
    """The partitions that can hold mjd from ``start`` to ``end``. Catalyst cannot derive this from
    a predicate on ``mjd``. Tables whose partition width is not known are left as they are."""
    width = day_width(alerts)
    if width is not None and start is not None and math.isfinite(start):
        alerts = alerts.where(F.col(DAY) > math.floor(start) - width)
    if width is not None and end is not None and math.isfinite(end):
        alerts = alerts.where(F.col(DAY) <= math.floor(end))
    return alerts


def prune_days(alerts: DataFrame, start: float | None, end: float | None) -> DataFrame:
    """Window on mjd that also bounds the partition column ``mjd_day``."""
    if start is not None:
        alerts = alerts.where(F.col("mjd") >= start)
    if end is not None:
        alerts = alerts.where(F.col("mjd") <= end)
    return _bound_days(alerts, start, end)
