"""The five tables as Parquet in key buckets.

A load writes new folders for the buckets it touches, under an id of its own, and is then listed in the
log with them; readers take each bucket from the last load that lists it. A load that fails half way
is never listed, so nothing of it is seen, and two loads never write to the same folder.

The log has one file per load number, made only where there is none: of two loads that began from the same state one is listed
and the other fails. A load also lists what became of its rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom.schemas import TABLES

BUCKET = "_bucket"
BUCKETS = 16
COUNTS = "rows_read bigint, rows_refused bigint, rows_superseded bigint, rows_replaced bigint, rows_inserted bigint, rows_kept bigint"
LOG = (
    "load int, id string, parts array<struct<table:string,bucket:int,of:int>>, "
    f"counts array<struct<table:string,{','.join(c.replace(' ', ':') for c in COUNTS.split(', '))}>>"
)


@dataclass(frozen=True)
class Counts:
    """What became of the rows of one table in a load.

    ``rows_read`` = refused + superseded (by a later row of the load) + replaced + inserted. ``rows_replaced``: keys that the
    table had; ``rows_inserted``: keys that it had not; ``rows_kept``: rows of the table that the load left alone.
    """

    table: str
    rows_read: int
    rows_refused: int
    rows_superseded: int
    rows_replaced: int
    rows_inserted: int
    rows_kept: int

    @property
    def rows(self) -> int:
        """Rows of the table after the load."""
        return self.rows_replaced + self.rows_inserted + self.rows_kept


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def loads(spark: SparkSession, root: str) -> list[Row]:
    """Finished loads in order: one row each, with the buckets that it wrote."""
    try:
        return sorted(spark.read.schema(LOG).json(f"{root}/loads").collect(), key=lambda r: r["load"])
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def last_load(spark: SparkSession, root: str) -> int | None:
    """Number of the last finished load, None before the first."""
    found = loads(spark, root)
    return found[-1]["load"] if found else None


def buckets_of(found: Iterable[Row], name: str) -> int | None:
    """Number of buckets of a table after the given loads, None if none of them wrote it."""
    numbers = [part["of"] for r in found for part in r["parts"] if part["table"] == name]
    return numbers[-1] if numbers else None


def rows_of(found: Iterable[Row], name: str) -> int:
    """Rows of a table after the given loads."""
    counts = [c for r in found for c in r["counts"] if c["table"] == name]
    return counts[-1]["rows_replaced"] + counts[-1]["rows_inserted"] + counts[-1]["rows_kept"] if counts else 0


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with this text where there is none, as a whole; False if there is one.

    The text is written aside and then given its name, which a local file system (by a link) and HDFS (by a rename that never
    replaces) do for exactly one of several callers. On a store without such a rename run one load at a time.
    """
    jvm = spark._jvm
    final = jvm.org.apache.hadoop.fs.Path(path)
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    final = files.makeQualified(final)
    aside = jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getUri().getScheme() != "file":
            return not files.exists(final) and files.rename(aside, final)
        try:
            jvm.java.nio.file.Files.createLink(jvm.java.io.File(final.toUri()).toPath(), jvm.java.io.File(aside.toUri()).toPath())
        except Py4JJavaError as failed:
            if failed.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True
    finally:
        files.delete(aside, False)


def record_load(
    spark: SparkSession, root: str, load: int, load_id: str, parts: Iterable[tuple[str, int, int]], counts: Iterable[Counts]
) -> None:
    """List a finished load, unless another was listed under its number."""
    entry = {
        "load": load,
        "id": load_id,
        "parts": [{"table": t, "bucket": b, "of": n} for t, b, n in parts],
        "counts": [asdict(c) for c in counts],
    }
    if not _publish(spark, f"{root}/loads/{load:08d}.json", json.dumps(entry) + "\n"):
        raise RuntimeError(f"another load into {root} finished meanwhile; repeat this one")


def load_counts(spark: SparkSession, root: str) -> DataFrame:
    """What became of the rows of every load: load, table_name and the counters, one row per load and table."""
    listed = spark.read.schema(LOG).json(f"{root}/loads").select("load", F.inline("counts"))
    return listed.select("load", F.col("table").alias("table_name"), *[c.split()[0] for c in COUNTS.split(", ")])


def load_path(root: str, name: str, load_id: str) -> str:
    return f"{root}/{name}/{load_id}"


def read(
    spark: SparkSession, root: str, name: str, load: int | None = None, only: Iterable[int] | None = None
) -> DataFrame:
    """A table as of a load, the last one by default; ``only`` some of its buckets."""
    found = [r for r in loads(spark, root) if load is None or r["load"] <= load]
    if not found:
        raise ValueError(f"no finished load in {root}")
    wanted = None if only is None else set(only)
    # a load that raises the number of buckets writes all of them
    number = buckets_of(found, name)
    last = {
        part["bucket"]: f"{load_path(root, name, r['id'])}/{BUCKET}={part['bucket']}"
        for r in found
        for part in r["parts"]
        if part["table"] == name and part["of"] == number and (wanted is None or part["bucket"] in wanted)
    }
    schema = TABLES[name].schema
    return spark.read.schema(schema).parquet(*last.values()) if last else spark.createDataFrame([], schema)


def write_buckets(merged: DataFrame, root: str, name: str, load_id: str, buckets: int) -> None:
    """Write the rows of a load by bucket; large buckets are split between tasks."""
    placed = merged.withColumn(BUCKET, bucket_of(TABLES[name].key, buckets)).hint("rebalance", BUCKET)
    placed.write.partitionBy(BUCKET).parquet(load_path(root, name, load_id))


def read_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    load = last_load(spark, root)
    return {name: read(spark, root, name, load) for name in TABLES}


def register_views(spark: SparkSession, root: str) -> None:
    """Name the tables of the last load for ``spark.sql``."""
    for name, frame in read_all(spark, root).items():
        frame.createOrReplaceTempView(name)


def save_bucketed(frame: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save as a catalog table bucketed and sorted by ``key``.

    Orders, items and payments bucketed alike by ``order_id`` are totalled and joined in place,
    with no shuffle.
    """
    frame.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
