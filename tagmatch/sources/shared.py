"""Folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders that stored tables were written to, in order.
_written: list[str] = []

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that an executor hands to a Python worker at once, where rows hold whole texts.
TEXTS_AT_ONCE = 500


def shared_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder under the session's ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; a cluster has to
    set it, since its machines share no temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tagmatch-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows read from a table written to the shared folder. Runs the plan
    once for all later uses; a lost executor cannot take the table along."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_name() -> str:
    return f"tagmatch_{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What jobs begun in the block shuffle is deleted as each ends; otherwise it stays on
    disk until the driver happens to collect its garbage.

    Only for jobs whose result is written or fetched in the block: of a DataFrame that is
    made in it and run twice, Spark would have to shuffle all over again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run in the block hand Python workers ``TEXTS_AT_ONCE`` rows at once, or fewer if
    the session says so. An executor holds each batch several times, once on either side
    and again as Python objects, and its workers keep the memory of their largest one.

    Only for jobs that run in the block: a DataFrame takes the setting when it is run.
    """
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(min(int(before), TEXTS_AT_ONCE) if int(before) > 0 else TEXTS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


@contextmanager
def kept_by(df: DataFrame, name: str, key: str, buckets: int) -> Iterator[DataFrame]:
    """The same rows for the block, read from a table that is laid out by ``key``, so that
    grouping by it needs no exchange. The table is deleted at the block's end."""
    spark = df.sparkSession
    path, table = shared_folder(spark, name), table_name()
    rows = df.repartition(buckets, key)
    try:
        with shuffles_deleted(spark):
            rows.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        _delete(spark, path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored in the block are deleted at its end, by whatever way it ends.

    Results are lazy and read stored tables, so write or collect them inside the block.
    """
    before = len(_written)
    try:
        yield
    finally:
        for folder in _written[before:]:
            _delete(spark, folder)
        del _written[before:]
