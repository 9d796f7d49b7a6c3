"""What the operators share: reading, intermediate tables, and the word pattern."""

from __future__ import annotations

import gc
import time
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_path

# A word, as Java and Python read it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders of the frames that ``stored`` gave.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(frame: DataFrame, name: str, *partitions: str) -> DataFrame:
    """The frame, written once as Parquet to the shared folder, in parts by ``partitions``, and read back.

    It is computed once, its lineage ends there, and a lost executor costs no more than its tasks.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    frame.write.partitionBy(*partitions).parquet(path)
    back = spark.read.schema(frame.schema).parquet(path)
    _PATHS[back] = path
    return back


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the folders of stored frames after their last reader, and let Spark drop the shuffle files of jobs that are done,
    which it does for those that the driver has no reference to any more."""
    for frame in frames:
        path = spark._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(frame))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    for _ in range(2):
        # the frames of a job that has just ended are held for a moment
        time.sleep(0.5)
        gc.collect()
        spark._jvm.System.gc()


def word_count(text: Column) -> Column:
    """Number of words of a text, null if the text is null; built-in functions only."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def bucket_of(key: Column, remainder: int) -> Column:
    """crc32 of the key as text, modulo ``remainder``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % remainder


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names like the given ones that no column of a frame has, in any case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
