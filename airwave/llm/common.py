"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Staged tables go to the shared folder that the cluster names in spark.checkpoint.dir.
from airwave.sources.artifacts import cut as staged
from airwave.sources.artifacts import remove, temporary
from airwave.sources.artifacts import shared_folder as scratch_dir

__all__ = ["KEY", "SPACE", "as_array", "id_remainder", "map_batches", "read_table", "remove", "row_key", "scratch_dir", "shuffle_width", "sized", "sliced", "staged", "temporary", "utf8"]

#: Words of the contracts are runs of bytes other than 0x20 and 0x09-0x0D; ``bytes.split()`` cuts at exactly these.
SPACE = b" \t\n\r\x0b\x0c"


#: Rows of a batch that are worked on at once, so that a task's texts and results are those of few rows.
SLICE = 1 << 10


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: T.StructType | str, slices: bool = False) -> DataFrame:
    """mapInArrow with a function from a batch to the columns of the result; the state of a task is one batch, or SLICE rows of it on request."""
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches) if slices else batches:
            if not batch.num_rows:
                continue
            out = fn(batch)
            yield pa.RecordBatch.from_arrays([as_array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(go, struct)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches; workers outlive their tasks, so memory that Arrow holds and does not use goes back at the end."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)
        del batch
    pa.default_memory_pool().release_unused()


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes; null as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


#: The type of row_key, for schemas.
KEY = "struct<a:long,b:long>"


def row_key(*names: str) -> Column:
    """A 128-bit key of a row's content, two hashes of different seeds. Equal rows share it, and operators give them equal results."""
    content = [*(F.col(n) for n in names), *(F.col(n).isNull() for n in names)]
    return F.struct(F.xxhash64(*content).alias("a"), F.xxhash64(F.lit("second"), *content).alias("b"))


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids give null."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of a few numbers each that may be broadcast: about 20 MB.
FEW = 1 << 18


def sized(written: DataFrame) -> DataFrame:
    """The side of a join: broadcast if it is counted to be few rows of a few numbers, else in a sort-merge join, whose hot keys Spark splits."""
    return F.broadcast(written) if written.count() <= FEW else written.hint("merge")
