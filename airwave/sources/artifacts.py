"""Named results in shared storage: written once, read many times."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Used where spark.checkpoint.dir is unset and driver and executors are one machine, as in tests.
LOCAL_FOLDER = "/tmp/checkpoints"
_SCOPES: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. A cluster has to name it; only a local master may do without."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = LOCAL_FOLDER
    return root.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is cut inside; it is deleted at the end, so results have to be written before."""
    folder = f"{shared_folder(spark)}/airwave/run-{uuid.uuid4().hex}"
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        remove(spark, folder)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a result is there whole: writers leave a mark when all of it is."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def name_of(kind: str, *inputs: object) -> str:
    """A result's name, made of what it is computed from: inputs and parameters in order."""
    return f"{kind}-{hashlib.md5('%'.join(map(str, inputs)).encode()).hexdigest()}"


def save(df: DataFrame, name: str, overwrite: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Write df under a name unless it is there whole already (or overwrite), and read it back.

    What a writer left that did not end has no mark and is written anew.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/airwave/{name}"
    if overwrite or not complete(spark, path):
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.parquet(path)


def cut(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """A fresh artefact: cuts lineage between the steps of an iteration. Without ``temporary`` it stays, as its readers are lazy."""
    folder = _SCOPES[-1] if _SCOPES else f"{shared_folder(df.sparkSession)}/airwave"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_of(values: Column, unique: bool = True, how: str = "md5") -> Column:
    """Hash of an ordered list of strings, joined by '%'."""
    joined = F.concat_ws("%", F.array_sort(F.array_distinct(values) if unique else values))
    return {"md5": F.md5, "sha1": F.sha1, "sha256": lambda c: F.sha2(c, 256)}[how](joined)
