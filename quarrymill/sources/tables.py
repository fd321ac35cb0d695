"""Tables: reading, written intermediates, manifests."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where it is unset and the master is local, a temporary folder of this machine."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="quarrymill-"))
    return "file://" + _LOCAL[0]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage and survives lost executors."""
    path = new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def dropped(*tables: DataFrame) -> None:
    """Delete the folders of tables made by :func:`written` once nothing reads them any more."""
    for own in tables:
        if path := _PATHS.pop(own, None):
            drop_path(own.sparkSession, path)


def released(spark: SparkSession) -> None:
    """Let the driver collect its garbage, for loops of many jobs.

    Spark deletes the shuffle files and broadcasts of what has run only once the
    driver's heap has been collected, and a heap that isn't grows to its limit.
    """
    spark._jvm.System.gc()


def manifest(df: DataFrame, stage: str, *columns: str) -> DataFrame:
    """One row for a stage: number of rows and an order-independent digest of the named columns."""
    digest = F.sum(F.conv(F.substring(F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in columns))), 1, 12), 16, 10).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(digest, F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest")).select(F.lit(stage).alias("stage"), "rows", "digest")
