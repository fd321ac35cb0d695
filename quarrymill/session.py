"""Session defaults: adaptive execution with skew handling, UTC, Arrow."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "quarrymill", master: str | None = None, **conf: str) -> SparkSession:
    """A session for tests and tools; on a cluster the submitted settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    return builder.config(map=defaults | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()
