"""Helpers that the operators share: the shared folder, cut lineage, joins on keys that may be hot, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A key is hot if it holds more than one in so many of the rows; so there are at most this many hot keys.
HOT_SHARES = 200
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. A temporary one only where it is unset."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="inkfold-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Sets the session's limit on the rows of an Arrow batch, if it is higher: texts are long, and tasks hold whole batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def map_batches(df: DataFrame, batch: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """df through a function from Arrow batch to Arrow batch, in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            if one.num_rows:
                yield batch(one)

    return df.mapInArrow(run, schema)


def filter_batches(df: DataFrame, column: str, keep: Callable[[pa.Array], Sequence[bool]]) -> DataFrame:
    """The rows of df, all columns as they are, for which keep, given a batch's values of one column, says True."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            if one.num_rows:
                yield one.filter(pa.array(keep(one.column(at)), pa.bool_()))

    if any("." in c or "`" in c for c in df.columns):  # such names are taken for paths
        plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
        return plain.mapInArrow(run, plain.schema).toDF(*df.columns)
    return df.mapInArrow(run, df.schema)


def hot_keys(counted: DataFrame, key: str, n: str = "n", shares: int = HOT_SHARES) -> list:
    """The keys with more than 1 in shares of all rows, from one row (key, n) per key. At most shares keys come back."""
    total = counted.agg(F.sum(n)).first()[0] or 0
    least = max(total // shares, 1)
    return [row[0] for row in counted.where(F.col(n) > least).select(key).collect()]


def bounded_sample(df: DataFrame, keys: Sequence[str], most: int, rows: int | None = None) -> DataFrame:
    """About most rows of df (all, if there are fewer), chosen by a hash of the columns keys, and never over twice as many.

    No rows are ordered or gathered for the choice. df is counted once, unless its number of rows, with distinct keys, is given.
    """
    n = df.count() if rows is None else rows
    if n <= most:
        return df
    share = df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 31)) < int((1 << 31) * most / n))
    return share.limit(2 * most) if rows is None else share


def salted_join(
    left: DataFrame, right: DataFrame, key: str, hot: Sequence, salt_from: str, salts: int = 64, how: str = "inner"
) -> DataFrame:
    """left joined with right, which has one row for each key, on the column key.

    Rows of left with a hot key are dealt over salts tasks by a hash of salt_from; right's rows of those keys are
    repeated once for each salt. Both are functions of the rows, so that a task run again deals them alike.
    """
    if not hot:
        return left.join(right, key, how)
    salt = F.when(F.col(key).isin(list(hot)), F.pmod(F.xxhash64(salt_from), F.lit(salts))).otherwise(F.lit(0))
    copies = F.when(F.col(key).isin(list(hot)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return (
        left.withColumn("_salt", salt.cast("int"))
        .join(right.withColumn("_salt", F.explode(copies)), [key, "_salt"], how)
        .drop("_salt")
    )


def connected(edges: DataFrame, most: int = 60) -> DataFrame:
    """The components of an undirected graph: one row (id, component) for each id in edges (a, b), longs.

    Large-star and small-star rounds: each id takes over the least id it knows of, until nothing changes. A hub's edges
    are reduced to their least id before the shuffle; in the join that finds them again, the edges of an id with over 1 in 200 of
    all are dealt over tasks by their other end. Rows with a = b are allowed.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL")
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    own = edges.where("a = b")
    edges = edges.where("a > b")
    mark = None
    for _ in range(most):
        edges = cut(_small_star(cut(_large_star(edges))))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    found = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    heads = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    single = own.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found.union(heads).union(single).groupBy("id").agg(F.min("component").alias("component"))


def _with_least(edges: DataFrame, least: Column, kept: Column) -> tuple[DataFrame, DataFrame]:
    """The kept edges (a, b), each with m, what least gives over all edges of its a; and one row (a, m) for each a."""
    found = cut(edges.groupBy("a").agg(least.alias("m"), F.count(F.lit(1)).alias("n")))
    heads = found.select("a", "m")
    return salted_join(edges.where(kept), heads, "a", hot_keys(found, "a"), "b"), heads


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined, _ = _with_least(both, F.least(F.min("b"), F.first("a")), F.col("b") > F.col("a"))
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    joined, heads = _with_least(edges, F.min("b"), F.lit(True))
    kept = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return kept.union(heads.select("a", F.col("m").alias("b"))).distinct()
