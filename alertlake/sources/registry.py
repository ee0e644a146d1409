"""Readers by name."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from alertlake.schema import LOCUS_SCHEMA
from alertlake.sources import files, locus, orbits, portal, wire

Reader = Callable[..., DataFrame]
_READERS: dict[str, Reader] = {}


def register(name: str, reader: Reader) -> Reader:
    _READERS[name] = reader
    return reader


def get(name: str) -> Reader:
    try:
        return _READERS[name]
    except KeyError:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(names())}") from None


def names() -> list[str]:
    return sorted(_READERS)


def read(spark: SparkSession, name: str, *args: Any, limit: int | None = None, **kw: Any):
    """Alerts of a named source; ``limit`` bounds the read over all its files."""
    out = get(name)(spark, *args, **kw)
    return out.limit(limit) if limit else out


for _name, _reader in files.READERS.items():
    register(_name, _reader)
register("files", files.read_alert_files)
register("portal_json", portal.read_portal_json)


def _loci(spark: SparkSession, path: str | list[str], **options: Any) -> DataFrame:
    """Loci as JSON lines, or as Parquet where ``format`` says so."""
    kind = options.pop("format", "json")
    return spark.read.schema(LOCUS_SCHEMA).options(**options).format(kind).load(path)


def _orbits(spark: SparkSession, path: str | list[str], **options: Any) -> DataFrame:
    """CSV of orbital elements with a header."""
    rows = spark.read.options(header=True, inferSchema=True, escape='"', **options).csv(path)
    return orbits.orbits_to_alerts(rows)


def _messages(spark: SparkSession, path: str | list[str], **options: Any) -> DataFrame:
    """Framed messages kept in Parquet; those that do not decode are left out."""
    good, _ = wire.decode_messages(spark.read.parquet(path), **options)
    return good


register("locus_latest", lambda spark, path, **o: locus.locus_latest(_loci(spark, path, **o)))
register("locus_history", lambda spark, path, **o: locus.locus_history(_loci(spark, path, **o)))
register("orbits", _orbits)
register("messages", _messages)
