"""A Spark session with the settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Skewed partitions are split and small ones merged at run time. Arrow batches for parsers are bounded in
# bytes by Spark itself; the row bound keeps a batch of large attachments from growing before that.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(name: str = "inkfold", master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """Session for ``name`` with the settings above and any others given."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
