"""Texts changed by what an operator has found, joined by the rows' keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from airwave.llm.common import sliced, staged


def rewrite_text(docs: DataFrame, key: Column, found: DataFrame, column: str, change: Callable, rejected: Column | None = None) -> DataFrame:
    """docs, its text changed by change(text, value) where found has a value for its key; n_chars is counted anew.

    found has one row for each key of a document that changes, or that goes as ``rejected`` says. It is written first: Spark then
    knows its size, broadcasts it below spark.sql.autoBroadcastJoinThreshold, and shuffles texts only beyond that.
    """
    going = F.lit(False) if rejected is None else rejected
    found = staged(found.select(F.col("key").alias("__key"), F.col(column).alias("__value"), going.alias("__goes")), "found")
    rows = docs.withColumn("__key", key).join(found, "__key", "left").where(~F.coalesce("__goes", F.lit(False)))
    schema = to_arrow_schema(docs.schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            columns = dict(zip(schema.names, batch.columns, strict=False))
            values = batch.column(len(schema.names)).to_pylist()
            if any(values):
                texts = columns["text"].to_pylist()
                sizes = columns["n_chars"].to_pylist() if "n_chars" in columns else [None] * len(texts)
                for i, value in enumerate(values):
                    if value:
                        texts[i] = change(texts[i], value)
                        sizes[i] = len(texts[i])
                columns["text"] = pa.array(texts, schema.field("text").type)
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array(sizes, schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=schema)

    return rows.select(*docs.columns, "__value").mapInArrow(cut, docs.schema)
