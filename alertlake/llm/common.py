"""Shared helpers of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.session import scratch_path

#: Rows of an Arrow batch that are turned into Python objects at once.
ROWS_AT_ONCE = 256

# The characters the contracts count as space between words.
SPACE_CLASS = r"[\x20\x09-\x0D]"

_built: dict[object, object] = {}


def built_once(key: object, build: Callable[[], object]) -> object:
    """What ``build`` made for ``key`` in this worker process; the last one made of each kind is kept."""
    kind = key[0]
    if kind not in _built or _built[kind][0] != key:
        _built[kind] = (key, build())
    return _built[kind][1]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column has it (names compare without case)."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: cuts the lineage.

    A lost executor costs its unfinished tasks only, because the files stay.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], size: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each text; None for null."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def with_computed(
    df: DataFrame,
    name: str,
    kind: T.DataType,
    inputs: Sequence[str],
    compute: Callable[..., list | pa.Array],
) -> DataFrame:
    """``df`` with the column ``name``, computed for slices of rows in Python workers.

    ``compute`` takes one Arrow array for each input column and returns a value for each row, as a
    list or an Arrow array.
    Other columns pass through as they are, whatever their names.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType([*df.schema.fields, T.StructField(name, kind, True)])
    arrow_type = to_arrow_type(kind)
    places = [df.columns.index(x) for x in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = compute(*(part.column(i) for i in places))
            made = values if isinstance(values, pa.Array) else pa.array(values, type=arrow_type)
            names = [*part.schema.names, name]
            yield pa.RecordBatch.from_arrays([*part.columns, made], names=names)

    return df.mapInArrow(run, schema)
