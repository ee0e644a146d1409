"""Jobs over image stamps. Bytes reach Python only where pixels or gzip are looked at."""

from __future__ import annotations

import gzip
import zlib
from dataclasses import dataclass
from datetime import datetime
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.functions import exprs as X
from alertlake.operators.views import _instant
from alertlake.schema import CUTOUT_FIELDS

KINDS = ("science", "template", "difference")
# Leading bytes, and sizes of the image format.
GZIP_MAGIC, IMAGE_MAGIC = "1F8B", "53494D504C45"
CARD, BLOCK = 80, 2880
_DTYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}



def _row_type(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _NUMBER, _FLAG = T.StringType(), T.DoubleType(), T.BooleanType()
_STATS = _row_type(
    verdict=_TEXT,
    error=_TEXT,
    shape=_TEXT,
    dtype=_TEXT,
    min=_NUMBER,
    max=_NUMBER,
    mean=_NUMBER,
    median=_NUMBER,
    std=_NUMBER,
    has_nan=_FLAG,
    has_inf=_FLAG,
)
_COMPARED = _row_type(
    shape_match=_FLAG,
    shape=_TEXT,
    residual_rms=_NUMBER,
    diff_peak=_NUMBER,
    diff_snr=_NUMBER,
    error=_TEXT,
)


def _key_columns(nested: bool) -> dict[str, str]:
    return {
        "alert_id": "alertId" if nested else "alert_id",
        "dia_source_id": "diaSource.diaSourceId" if nested else "dia_source_id",
        "dia_object_id": "diaSource.diaObjectId" if nested else "dia_object_id",
        "mjd": "diaSource.midPointTai" if nested else "mjd",
    }


def stamps_long(packets: DataFrame) -> DataFrame:
    """One row per packet and stamp column: kind, data."""
    keys = _key_columns("diaSource" in packets.columns)
    each = [
        F.struct(F.lit(kind).alias("kind"), F.col(name).alias("data"))
        for kind, name in zip(KINDS, CUTOUT_FIELDS)
        if name in packets.columns
    ]
    return packets.select(
        *[F.col(c).alias(n) for n, c in keys.items()], F.inline(F.array(*each))
    )


@F.pandas_udf(T.BinaryType())
def _gunzip(data: pd.Series) -> pd.Series:
    """Unpacked bytes; null where the data is no intact gzip."""

    def unpack(raw):
        try:
            return None if raw is None else gzip.decompress(raw)
        except (OSError, EOFError, zlib.error):
            return None

    return data.map(unpack)


def _starts(data: Column, magic: str) -> Column:
    return F.hex(F.substring(data, 1, len(magic) // 2)) == magic


def classify_stamps(stamps: DataFrame, *, keep_data: bool = False) -> DataFrame:
    """verdict (absent, valid, invalid), is_gzip, stored and unpacked size.

    Only gzip members go through Python; for all other rows it is handed a null.
    """
    raw = F.col("data")
    zipped = F.coalesce(_starts(raw, GZIP_MAGIC), F.lit(False))
    unpacked = stamps.withColumn("is_gzip", zipped).withColumn(
        "_unzipped", _gunzip(F.when(F.col("is_gzip"), raw))
    )
    plain = F.when(F.col("is_gzip"), F.col("_unzipped")).otherwise(raw)
    verdict = (
        F.when(raw.isNull() | (F.octet_length(raw) == 0), "absent")
        .when(F.coalesce(_starts(plain, IMAGE_MAGIC), F.lit(False)), "valid")
        .otherwise("invalid")
    )
    out = unpacked.withColumn("verdict", verdict)
    out = out.withColumn("stored_bytes", F.octet_length(raw).cast("long")).withColumn(
        "plain_bytes", F.octet_length(plain).cast("long")
    )
    return out.withColumn("data", plain).drop("_unzipped") if keep_data else out.drop(
        "_unzipped", "data"
    )


def planned_paths(
    classified: DataFrame,
    base: str,
    written_at: Column,
    *,
    by_date: bool = True,
    by_object: bool = False,
    compress: bool = False,
) -> DataFrame:
    """Add the output path of each stamp; null for a rejected one."""
    path = X.cutout_path(
        base,
        "mjd",
        "dia_source_id",
        "kind",
        written_at,
        object_id=F.col("dia_object_id") if by_object else None,
        by_date=by_date,
        compress=compress,
    )
    return classified.withColumn("path", F.when(F.col("verdict") == "valid", path))


def stamp_paths(
    packets: DataFrame,
    base: str,
    written_at: Column,
    *,
    by_date: bool = True,
    by_object: bool = False,
    compress: bool = False,
) -> DataFrame:
    """Per alert the three ``<kind>_cutout_path`` columns, from the packet's own row: no shuffle."""
    nested = "diaSource" in packets.columns
    rows = packets.select(
        *[F.col(c).alias(n) for n, c in _key_columns(nested).items()],
        *[F.col(c).alias(k) if c in packets.columns else F.lit(None).cast("binary").alias(k) for k, c in zip(KINDS, CUTOUT_FIELDS)],
    )
    paths = []
    for kind in KINDS:
        path = X.cutout_path(
            base,
            "mjd",
            "dia_source_id",
            F.lit(kind),
            written_at,
            object_id=F.col("dia_object_id") if by_object else None,
            by_date=by_date,
            compress=compress,
        )
        paths.append(F.when(_is_image(F.col(kind)), path).alias(f"{kind}_cutout_path"))
    return rows.select("alert_id", "dia_source_id", *paths)


def _is_image(raw: Column) -> Column:
    """True for stamps whose verdict is valid; gzip members only are unpacked."""
    zipped = F.coalesce(_starts(raw, GZIP_MAGIC), F.lit(False))
    plain = F.when(zipped, _gunzip(F.when(zipped, raw))).otherwise(raw)
    return F.coalesce(_starts(plain, IMAGE_MAGIC), F.lit(False))


def compare_packets(packets: DataFrame) -> DataFrame:
    """``compare_triplets`` for packets whose three stamps are images, from the packet's own row."""
    nested = "diaSource" in packets.columns
    names = _key_columns(nested)
    rows = packets.select(
        F.col(names["alert_id"]).alias("alert_id"),
        F.col(names["dia_source_id"]).alias("dia_source_id"),
        *[F.col(c).alias(k) for k, c in zip(KINDS, CUTOUT_FIELDS)],
    )
    given = reduce(Column.__and__, (F.octet_length(k) > 0 for k in KINDS))
    compared = rows.where(given).select("alert_id", "dia_source_id", _compared_images(*KINDS).alias("_c"))
    return compared.where("_c.images").select("alert_id", "dia_source_id", "_c.*").drop("images")


def path_columns(planned: DataFrame) -> DataFrame:
    """Per alert the three ``<kind>_cutout_path`` columns of the flat schema."""
    return planned.groupBy("alert_id", "dia_source_id").agg(
        *[
            F.max(F.when(F.col("kind") == k, F.col("path"))).alias(f"{k}_cutout_path")
            for k in KINDS
        ]
    )


def read_stamp_files(spark: SparkSession, path: str) -> DataFrame:
    """Files ``SOURCE_KIND_TIME.fits[.gz]`` below a folder; their content is only read by
    queries that use it."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.fits*")
        .load(path)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        "path",
        "length",
        "modificationTime",
        F.regexp_extract(name, r"^(\d+)_", 1).try_cast("long").alias("dia_source_id"),
        F.nullif(F.regexp_extract(name, r"_(science|template|difference)_", 1), F.lit("")).alias(
            "kind"
        ),
        F.nullif(F.regexp_extract(name, r"_(\d{8}_\d{6})\.", 1), F.lit("")).alias("stamp_time"),
        F.col("content").alias("data"),
    )


def inventory(files: DataFrame) -> DataFrame:
    """Files and bytes per kind."""
    return files.groupBy("kind").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.round(F.sum("length") / (1024 * 1024), 2).alias("megabytes"),
    )


def expired_files(files: DataFrame, days: int = 30, as_of: datetime | None = None) -> DataFrame:
    limit = _instant(as_of) - F.make_dt_interval(F.lit(days))
    return files.where(F.col("modificationTime") < limit).select("path", "modificationTime")


# --- pixels ----------------------------------------------------------------------------------


class BadImage(ValueError):
    """An image that cannot be decoded."""


@dataclass(frozen=True)
class _Layout:
    """Where the pixels of an image begin, and what they are."""

    start: int
    axes: tuple[int, ...]
    dtype: np.dtype
    scale: float
    zero: float
    count: int

    @property
    def size(self) -> int:
        return self.count * self.dtype.itemsize


def _parsed_layout(raw: bytes) -> _Layout:
    cards: dict[str, str] = {}
    at = 0
    while "END" not in cards:
        card = raw[at : at + CARD].decode("ascii", "replace")
        if len(card) < 3:
            raise BadImage("header without END")
        value = card[10:].split("/")[0].strip() if card[8:10] == "= " else ""
        cards.setdefault(card[:8].strip(), value)
        at += CARD
    try:
        axes = tuple(int(cards[f"NAXIS{i + 1}"]) for i in range(int(cards["NAXIS"])))
        dtype = np.dtype(_DTYPES[int(cards["BITPIX"])])
        scale, zero = float(cards.get("BSCALE", 1)), float(cards.get("BZERO", 0))
    except (KeyError, ValueError) as err:
        raise BadImage(f"bad header: {err}") from err
    count = int(np.prod(axes)) if axes else 0
    return _Layout(-(-at // BLOCK) * BLOCK, axes, dtype, scale, zero, count)


@lru_cache(maxsize=512)
def _block_layout(block: bytes) -> _Layout | None:
    """The layout, if the header ends in its first block; stamps of a survey share few headers."""
    ends = any(block[at : at + 8].strip() == b"END" for at in range(0, len(block), CARD))
    return _parsed_layout(block) if ends else None


#: The last header block seen, and its layout: comparing a block is cheaper than its hash.
_recent: list = [None, None]


def _layout_of(raw: bytes) -> _Layout:
    if _recent[0] is None or not raw.startswith(_recent[0]):
        block = raw[:BLOCK]
        layout = _block_layout(block)
        if layout is None:
            return _parsed_layout(raw)
        _recent[:] = block, layout
    return _recent[1]


_GZIP_START, _IMAGE_START = bytes.fromhex(GZIP_MAGIC), bytes.fromhex(IMAGE_MAGIC)


def _located(raw: bytes) -> tuple[_Layout, bytes]:
    """The layout of a simple primary image, and the bytes of its pixels."""
    if raw.startswith(_GZIP_START):
        try:
            raw = gzip.decompress(raw)
        except (OSError, EOFError, zlib.error) as err:
            raise BadImage(f"broken gzip: {err}") from err
    if not raw.startswith(_IMAGE_START):
        raise BadImage("no SIMPLE card")
    layout = _layout_of(raw)
    body = raw[layout.start : layout.start + layout.size] if layout.count else b""
    if len(body) < layout.size:
        raise BadImage("image data is cut short")
    return layout, body


def _pixels(layout: _Layout, bodies: list[bytes]) -> np.ndarray:
    """Images of one layout, stacked along the first axis."""
    pixels = np.frombuffer(b"".join(bodies), layout.dtype).reshape(len(bodies), *layout.axes[::-1])
    return pixels if (layout.scale, layout.zero) == (1.0, 0.0) else pixels * layout.scale + layout.zero


def decode_image(raw: bytes) -> np.ndarray | None:
    """Pixels of a simple primary image; None if it declares none."""
    layout, body = _located(raw)
    return _pixels(layout, [body])[0] if layout.count else None


def _shape(pixels: np.ndarray) -> str:
    return "x".join(str(n) for n in pixels.shape)


#: Pixels of one layout that are looked at together.
_PIXELS_AT_ONCE = 1 << 20


def _stats_array(stamps: list[bytes | None]) -> pa.StructArray:
    """Verdicts and figures in the order of the stamps; images of one layout are stacked."""
    n = len(stamps)
    verdict, error, shape, dtype = ["valid"] * n, [None] * n, [None] * n, [None] * n
    figures, odd, known = np.zeros((5, n)), np.zeros((2, n), bool), np.zeros(n, bool)
    by_layout: dict[int, tuple[_Layout, list[int], list[bytes]]] = {}

    def settle(layout: _Layout, at: list[int], bodies: list[bytes]) -> None:
        pixels = _pixels(layout, bodies)
        values = pixels.reshape(len(at), -1).astype("f8")
        figures[:, at] = [fn(values, axis=1) for fn in (np.min, np.max, np.mean, np.median, np.std)]
        odd[:, at] = [fn(values).any(axis=1) for fn in (np.isnan, np.isinf)]
        known[at] = True
        text, kind = _shape(pixels[0]), pixels.dtype.newbyteorder("=").name
        for k in at:
            shape[k], dtype[k] = text, kind

    for k, raw in enumerate(stamps):
        if not raw:
            verdict[k], error[k] = "empty", "the stamp has no bytes"
            continue
        try:
            layout, body = _located(raw)
        except BadImage as err:
            verdict[k], error[k] = "corrupt", str(err)
            continue
        if not layout.count:
            verdict[k], error[k] = "no_data", "the first header announces no pixels"
            continue
        _, at, bodies = by_layout.setdefault(id(layout), (layout, [], []))
        at.append(k)
        bodies.append(body)
        if len(at) * layout.count >= _PIXELS_AT_ONCE:
            settle(*by_layout.pop(id(layout)))
    for waiting in by_layout.values():
        settle(*waiting)
    texts = [pa.array(x, pa.string()) for x in (verdict, error, shape, dtype)]
    numbers = [pa.array(x, pa.float64(), mask=~known | np.isnan(x)) for x in figures]
    flags = [pa.array(x, pa.bool_(), mask=~known) for x in odd]
    return pa.StructArray.from_arrays([*texts, *numbers, *flags], names=_STATS.names)


@F.arrow_udf(_STATS)
def _pixel_stats(data: pa.Array) -> pa.Array:
    return _stats_array(data.to_pylist())


def pixel_statistics(stamps: DataFrame, *, fraction: float | None = None, seed: int = 0):
    """Verdict and pixel figures per stamp; ``fraction`` takes a sample of the stamps."""
    if fraction is not None and fraction < 1.0:
        stamps = stamps.sample(fraction=fraction, seed=seed)
    return stamps.withColumn("_s", _pixel_stats("data")).select(
        *[c for c in stamps.columns if c != "data"], "_s.*"
    )


def verdict_counts(statistics: DataFrame) -> DataFrame:
    return statistics.groupBy("verdict").agg(F.count(F.lit(1)).alias("stamps"))


def triplets(stamps: DataFrame, keys: tuple[str, ...] = ("dia_source_id",)) -> DataFrame:
    """Science, template and difference bytes of one alert side by side."""
    parts = [
        stamps.where(F.col("kind") == k).select(*keys, F.col("data").alias(k)) for k in KINDS
    ]
    return parts[0].join(parts[1], list(keys)).join(parts[2], list(keys))


def _images(row: tuple) -> list[tuple[_Layout, bytes]] | tuple:
    """The three images of equal shape, or the result of a row that has none."""
    try:
        images = [_located(bytes(raw)) for raw in row]
    except (BadImage, TypeError) as err:
        return (None, None, None, None, None, str(err))
    if not all(layout.count for layout, _ in images):
        return (None, None, None, None, None, "no image data")
    if not images[0][0].axes == images[1][0].axes == images[2][0].axes:
        return (False, None, None, None, None, None)
    return images


def _compare_rows(rows: list[tuple | None]) -> list[tuple]:
    """Results in the order of the rows; None stays a row of nulls. Rows of equal layouts are stacked."""
    found: list = [(None,) * len(_COMPARED)] * len(rows)
    by_layout: dict[tuple, list[tuple[int, list[tuple[_Layout, bytes]]]]] = {}

    def settle(waiting: list[tuple[int, list[tuple[_Layout, bytes]]]]) -> None:
        layouts = [layout for layout, _ in waiting[0][1]]
        bodies = ([images[k][1] for _, images in waiting] for k in range(3))
        sci, tmp, diff = (_pixels(*x).astype("f8") for x in zip(layouts, bodies))
        axes = tuple(range(1, sci.ndim))
        spread, peak = diff.std(axis=axes), diff.max(axis=axes)
        rms = np.sqrt(np.mean((sci - tmp - diff) ** 2, axis=axes))
        most = np.abs(diff).max(axis=axes)
        text, each = _shape(diff[0]), zip(waiting, rms.tolist(), most.tolist(), peak.tolist(), spread.tolist())
        for (n, _), r, m, p, s in each:
            found[n] = (True, text, r, m, p / s if s > 0 else None, None)

    for n, row in enumerate(rows):
        made = None if row is None else _images(row)
        if isinstance(made, tuple):
            found[n] = made
        elif made is not None:
            kinds = tuple(id(layout) for layout, _ in made)
            waiting = by_layout.setdefault(kinds, [])
            waiting.append((n, made))
            if len(waiting) * made[0][0].count >= _PIXELS_AT_ONCE:
                settle(by_layout.pop(kinds))
    for waiting in by_layout.values():
        settle(waiting)
    return found


def _struct_array(rows: list[tuple], kind: T.StructType) -> pa.StructArray:
    """Rows as a struct; NaN becomes null."""
    types = {_TEXT: pa.string(), _NUMBER: pa.float64(), _FLAG: pa.bool_()}
    columns = zip(*rows) if rows else [[]] * len(kind)
    arrays = [pa.array(list(c), types[f.dataType], from_pandas=True) for c, f in zip(columns, kind)]
    return pa.StructArray.from_arrays(arrays, names=kind.names)


@F.arrow_udf(_COMPARED)
def _compared(science: pa.Array, template: pa.Array, difference: pa.Array) -> pa.Array:
    stamps = zip(*(x.to_pylist() for x in (science, template, difference)))
    return _struct_array(_compare_rows(list(stamps)), _COMPARED)


def _unpacked(raw: bytes) -> bytes | None:
    try:
        return gzip.decompress(raw) if raw.startswith(_GZIP_START) else raw
    except (OSError, EOFError, zlib.error):
        return None


_COMPARED_IMAGES = T.StructType([*_COMPARED.fields, T.StructField("images", _FLAG)])


@F.arrow_udf(_COMPARED_IMAGES)
def _compared_images(science: pa.Array, template: pa.Array, difference: pa.Array) -> pa.Array:
    stamps = zip(*(x.to_pylist() for x in (science, template, difference)))
    plain = [tuple(_unpacked(raw) for raw in row) for row in stamps]
    images = [all(p is not None and p.startswith(_IMAGE_START) for p in row) for row in plain]
    found = _compare_rows([row if whole else None for row, whole in zip(plain, images)])
    return _struct_array([(*x, y) for x, y in zip(found, images)], _COMPARED_IMAGES)


def compare_triplets(rows: DataFrame) -> DataFrame:
    """Shape match, residual RMS, peak and peak SNR of the difference image."""
    return rows.withColumn("_c", _compared(*KINDS)).select(
        *[c for c in rows.columns if c not in KINDS], "_c.*"
    )
