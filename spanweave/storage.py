"""Intermediate tables in the shared folder of the cluster: written, read back, deleted."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables that the cluster names in spark.checkpoint.dir.

    Only a local session, as in tests, may do without; it gets a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not getattr(sc, "_spanweave_scratch", None):
            sc._spanweave_scratch = tempfile.mkdtemp(prefix="spanweave-")
        named = sc._spanweave_scratch
    return named.rstrip("/")


def _at(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop's."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back, which cuts its lineage.

    What is read back survives the loss of executors; ``forget`` deletes it, else the end of the driver does.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/spanweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at, system = _at(spark, path)
    system.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._spanweave_path = path
    return out


def unsent(df: DataFrame) -> DataFrame:
    """``df``, which joins then shuffle by their keys and do not send whole to the driver and all executors.

    For tables that grow with the data.  Spark broadcasts by a file's compressed size, of which the rows in
    memory may be many times as much, and the driver holds those of all joins of a query at once.
    """
    return df.hint("merge")


def forget(*frames: DataFrame | None) -> None:
    """Delete the tables of frames that ``cut`` gave and that no plan still to run reads."""
    for df in frames:
        if path := getattr(df, "_spanweave_path", None):
            at, system = _at(df.sparkSession, path)
            system.delete(at, True)
            system.cancelDeleteOnExit(at)
