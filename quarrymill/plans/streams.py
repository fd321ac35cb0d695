"""Queries that run the flow as a stream over whole tables and read what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..settings import DEFAULTS
from ..sources.tables import new_path, table
from ..streaming import flows
from . import matching


FILES = 4  # of equal ranges of the order, one micro-batch each


def _drained(spark: SparkSession, d: str, name: str, order: str, make) -> DataFrame:
    """The table as a stream of several micro-batches, in the order of ``order``, so that state passes from one to the next."""
    path = new_path(spark, f"stream-{name}")
    rows = table(spark, d, name)
    cuts = rows.agg(F.percentile_approx(order, [i / FILES for i in range(1, FILES)])).first()[0] or []
    part = sum(((F.col(order) > c).cast("int") for c in cuts), F.lit(0))
    for i in range(FILES):  # written one after another: a file's age is its place in the stream
        rows.where(F.coalesce(part, F.lit(0)) == i).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = make(flows.stream_table(spark, f"{path}/in", rows.schema))
    flows.drain(stream, f"{path}/out", f"{path}/state")
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def stream_cap(spark: SparkSession, d: str) -> DataFrame:
    return _drained(spark, d, "events", "event_id", lambda s: flows.capped_stream(s.select("user_id", "event_id"), "user_id", "event_id", 50))


def stream_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the queue, each once, whatever the micro-batches."""
    return _drained(spark, d, "work_item", "seq", lambda s: flows.distinct_keys(s.where("label is not null and url is not null").select("label", "url"), "label", "url"))


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Labels, reasons and counts; a record delivered again counts once."""
    vector = F.when(V.has_length(F.col("embedding"), 64), F.col("embedding")).alias("embedding")
    rows = _drained(spark, d, "dedup_item", "seq", lambda s: flows.deduplicated_stream(s.select("label", "seq", F.lower("md5").alias("md5"), "phash", vector), s=DEFAULTS))
    return rows.groupBy("label", "reason").count()


QUERIES = {f.__name__: f for f in (stream_cap, stream_distinct, stream_dedup)}

ORACLES = {
    "stream_cap": "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n <= 50",
    "stream_dedup": matching.REASONS + " SELECT label, reason, count(*) AS count FROM (SELECT i.label, coalesce(y.reason, 'new') AS reason FROM i LEFT JOIN y ON i.seq = y.seq) GROUP BY label, reason",
    "stream_distinct": "SELECT DISTINCT label, url FROM work_item WHERE label IS NOT NULL AND url IS NOT NULL",
}
