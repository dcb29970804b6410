"""Where notes come from: a table by handle, by path with an optional base, or a list of keys."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

UNID, NOTE_ID, POS, BATCH = "unid", "note_id", "pos", "batch"

_KEY_TYPES = {UNID: pa.string(), NOTE_ID: pa.int32()}


def open_path(spark: SparkSession, path: str, base: str | None = None, format: str = "parquet") -> DataFrame:
    """The table stored at ``path``, below ``base`` (a file system or folder) when one is given."""
    if not path:
        raise ValueError("a path is needed to open a table")
    return spark.read.format(format).load(f"{str(base).rstrip('/')}/{path.lstrip('/')}" if base else path)


def open_table(
    spark: SparkSession,
    table: DataFrame | str | None = None,
    path: str | None = None,
    base: str | None = None,
    format: str = "parquet",
) -> DataFrame:
    """A table by handle (a DataFrame or the name of a catalog table), else by path."""
    if isinstance(table, DataFrame):
        return table
    if table:
        return spark.table(table)
    if not path:
        raise ValueError("either a table or a path is needed")
    return open_path(spark, path, base, format)


def key_frame(spark: SparkSession, keys: Iterable, key: str) -> DataFrame:
    """A driver-side list of keys as ``(pos, key)``, in list order with repeats kept.

    Through Arrow the list becomes a local relation, whose exact size Spark knows when it plans.
    """
    values = list(keys)
    columns = {POS: pa.array(range(len(values)), pa.int64()), key: pa.array(values, _KEY_TYPES[key])}
    return spark.createDataFrame(pa.table(columns))
