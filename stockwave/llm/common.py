"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where ``body`` names it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that little text is held as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; once a task has given the last one, its Python worker, which other tasks take over, returns unused memory."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library keeps freed memory otherwise, where it is glibc
    if trim:
        trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name, also with dots; ``run`` gives its columns in the order of ``schema``."""
    names, places = df.columns, [f"c{i}" for i in range(len(schema))]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(run(pa.RecordBatch.from_arrays(b.columns, names) for b in batches)):
            yield pa.RecordBatch.from_arrays(batch.columns, places)

    sent = T.StructType([T.StructField(c, f.dataType) for c, f in zip(places, schema)])
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, sent).toDF(*schema.names)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores in front as keep them apart from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name)
        found.append(name)
    return found


def has_map(kind: T.DataType) -> bool:
    """Whether a type cannot be sorted by, as it holds a map in any depth."""
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType)) or isinstance(kind, T.ArrayType) and has_map(kind.elementType)


def row_order(df: DataFrame) -> list[Column]:
    """Sort keys that tell all different rows apart: columns that hold maps are compared as JSON."""
    quoted = [(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return [F.to_json(F.struct(c.alias("c"))) if has_map(kind) else c for c, kind in quoted]


def bucket_bits(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """How many leading bits of a digest split ``n_rows`` into buckets of about that many rows."""
    return min(24, max(4, (n_rows // rows_per_bucket).bit_length()))


def running_sum(
    df: DataFrame, group: str, key: str, value: Column, ties: Sequence[str], name: str, n_rows: int
) -> DataFrame:
    """Adds the sum of ``value`` over the rows before this one, per group, in the order of a hex digest.

    A group may hold most rows: rows are dealt to (group, leading bits of the digest), sums per
    bucket are added up first, and the rows of one bucket start from the sum of the buckets before.
    ``df`` is read twice, so it should be a stored table. ``group`` is not null.
    """
    bucket = F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), 32 - bucket_bits(n_rows)).cast("int")
    rows = df.withColumn("_bucket", bucket).withColumn("_value", value)
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(group, "_bucket").agg(F.sum("_value").alias("_sum"))
    sums = sums.select(group, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_bucket").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_before") + F.coalesce(F.sum("_value").over(inside), F.lit(0))
    return rows.join(sums, [group, "_bucket"]).withColumn(name, total).drop("_bucket", "_value", "_before")
