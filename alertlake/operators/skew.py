"""Previous row per key, without ever giving one task a whole hot key.

A plain ``lag`` over ``partitionBy(key)`` sends every row of a key to one task. Here rows are
dealt by ranges of (key, order), which cut a hot key wherever it is long, and sorted. Each
task looks back inside its own rows, a batch at a time; its first row has its previous row in
an earlier task. A second look at the same shuffle takes the first and the last row of each
task: a scan over these, one small row for each task, finds what precedes each first row.

Both looks have to see the same ranges. Spark reads one shuffle for both, as the plans below are
equal and their number of ranges is given; should it ever deal twice, first rows would not be
found among the heads, and the query stops instead of losing a previous row.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key with more rows than this is hot: ``has_hot_key`` tells a caller that has to choose.
ROWS_PER_TASK = 2_000_000
#: Parts by hash of the key that are counted before single keys are.
COARSE_PARTS = 4096

PREVIOUS = "_previous"
_TASK, _HEAD = "_task", "_head"


def has_hot_key(
    rows: DataFrame,
    key: str,
    rows_per_task: int = ROWS_PER_TASK,
    counted: tuple[Column, Mapping[int, int]] | None = None,
) -> bool:
    """Whether a key has more rows than a task should get. Parts by hash of the key are counted first,
    which shuffles next to nothing: only the keys of a part with more rows are counted one by one.
    ``counted`` is a part of the rows by hash of the key, and the rows of each, if known already."""
    many = F.col("n") > rows_per_task
    if counted is None:
        part = F.pmod(F.xxhash64(key), F.lit(COARSE_PARTS)).cast("int")
        full = [p for p, _ in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).where(many).collect()]
    else:
        part, full = counted[0], [p for p, n in counted[1].items() if n > rows_per_task]
    if not full:
        return False
    counts = rows.where(part.isin(full)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return not counts.where(many).limit(1).isEmpty()


def _look_back(key: str, values: Sequence[str], struct: pa.StructType):
    """Adds PREVIOUS to sorted rows, and whether a row is the first of its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # key and values of the row before this batch
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in (key, *values)}
            first = before is None
            if first:
                before = {c: pa.nulls(1, x.type) for c, x in columns.items()}
            shifted = {c: pa.concat_arrays([before[c], x.slice(0, n - 1)]) for c, x in columns.items()}
            now, ahead = columns[key], shifted[key]
            same = pc.or_(
                pc.fill_null(pc.equal(now, ahead), False), pc.and_(pc.is_null(now), pc.is_null(ahead))
            )
            if first:
                same = pa.concat_arrays([pa.array([False]), same.slice(1)])
            previous = pa.StructArray.from_arrays(
                [shifted[c].cast(f.type) for c, f in zip(values, struct)], fields=list(struct), mask=pc.invert(same)
            )
            before = {c: x.slice(n - 1, 1) for c, x in columns.items()}
            head = pa.array([first] + [False] * (n - 1), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, previous, head], names=[*batch.schema.names, PREVIOUS, _HEAD]
            )

    return run


def _ends(point: Sequence[str], carried: Sequence[str], schema: pa.Schema):
    """(task, point of its first row, carried columns of its last row) of the sorted rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head = tail = None
        for batch in batches:
            if batch.num_rows:
                tail = batch.slice(batch.num_rows - 1, 1)
                head = batch.slice(0, 1) if head is None else head
        if head is None:
            return

        def struct(row: pa.RecordBatch, names: Sequence[str], kind: pa.DataType) -> pa.Array:
            columns = [row.column(row.schema.get_field_index(c)).cast(f.type) for c, f in zip(names, kind)]
            return pa.StructArray.from_arrays(columns, fields=list(kind))

        task = pa.array([TaskContext.get().partitionId()], pa.int32())
        first = struct(head, point, schema.field("head").type)
        last = struct(tail, carried, schema.field("tail").type)
        yield pa.RecordBatch.from_arrays([task, first, last], schema=schema)

    return run


def with_previous(
    rows: DataFrame, key: str, order: Sequence[str], values: Sequence[str], *, tasks: int | None = None, any_hot: bool = True
) -> DataFrame:
    """Add struct ``_previous`` of ``values`` of the preceding row of the key (null if none).

    ``order`` must be a total order within the key, without nulls. ``tasks`` is the number of
    ranges; by default that of the session's shuffles. ``any_hot=False`` says that
    ``has_hot_key`` was asked: one window is then enough.
    """
    if not any_hot:
        window = Window.partitionBy(key).orderBy(*order)
        return rows.withColumn(PREVIOUS, F.lag(F.struct(*values)).over(window))
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    point, carried = [key, *order], [key, *(c for c in values if c != key)]
    kind = lambda names: T.StructType([T.StructField(c, rows.schema[c].dataType) for c in names])
    dealt = rows.repartitionByRange(tasks, *point).sortWithinPartitions(*point)

    schema = T.StructType().add(_TASK, "integer").add("head", kind(point)).add("tail", kind(carried))
    ends = dealt.mapInArrow(_ends(point, carried, to_arrow_schema(schema)), schema)
    handed = ends.select("head", F.lag("tail").over(Window.orderBy(_TASK)).alias("handed"))

    wide = T.StructType([*rows.schema.fields, T.StructField(PREVIOUS, kind(values)), T.StructField(_HEAD, T.BooleanType())])
    looked = dealt.mapInArrow(_look_back(key, values, to_arrow_type(kind(values))), wide)
    lost = F.raise_error(F.lit("two deals of one shuffle have different ranges")).cast(kind(values))
    joined = looked.join(F.broadcast(handed), F.when(F.col(_HEAD), F.struct(*point)) == F.col("head"), "left")
    before = F.struct(*(F.col(f"handed.{c}").alias(c) for c in values))
    previous = F.when(~F.col(_HEAD), F.col(PREVIOUS)).when(F.col("head").isNull(), lost)
    same = F.col("handed").isNotNull() & F.col(f"handed.{key}").eqNullSafe(F.col(key))
    return joined.withColumn(PREVIOUS, previous.when(same, before)).drop("head", "handed", _HEAD)
