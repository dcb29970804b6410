"""Mixing sources to target weights: how many words of each document a mix takes, so that each source meets its target.

Every row gets a hash-random key. The rows are range-sorted by source and key, and a running count of words gives each row its place in
its source: counts within a task's range, after the totals of the ranges before it. A source whose target is t words is taken whole
as often as t allows, then once more up to the row in which the rest of t ends, of which only the first words are taken.

DataFrame functions only. Texts are read once and not shuffled; what is sorted is a source, a key and a number of each row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkfold.llm.common import fresh_path

#: What sources weigh, by their place in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix for each word of the documents, and the most that a source is taken.
SHARE, MOST = 1.5, 2.0
#: A word.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a range, on average.
RANGE_ROWS = 2_000_000
#: Ranges' and sources' totals are broadcast up to so many rows, else joined by a shuffle.
BROADCAST_ROWS = 100_000


def words_in(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id: Column, text: Column, seed: int) -> Column:
    """60 bits that look random and are always the same for the same id and text."""
    named = F.concat_ws(":", F.lit(seed), id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def _small(frame: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def running_totals(rows: DataFrame, by: str, order: Sequence[str], values: dict[str, str], n: int) -> DataFrame:
    """rows (n of them) with, for each name in values, the sum of that column over the rows of the same by that come before.

    Rows are dealt into ranges of (by, order) and written; a range's rows are summed by a window of their own, and what the ranges
    before hold is added. So no task sees more than a range, however many rows one value of by has; order should tell rows apart,
    or those that are alike stay in one range. The columns _range and _by are taken.
    """
    session = rows.sparkSession
    ranges = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-n // RANGE_ROWS))
    path = fresh_path(session, "ranges")
    rows.repartitionByRange(ranges, by, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = session.read.parquet(path)
    sums = dealt.groupBy(F.col(by).alias("_by"), "_range").agg(*[F.sum(v).alias(name) for name, v in values.items()])
    ahead = W.partitionBy("_by").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    path = fresh_path(session, "totals")
    sums.select("_by", F.col("_range").alias("_at"), *[F.coalesce(F.sum(name).over(ahead), F.lit(0)).alias(f"_{name}") for name in values]).write.parquet(path)
    starts = session.read.parquet(path)
    joined = dealt.join(_small(starts, starts.count()), F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_at")))
    inside = W.partitionBy("_range", by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = [(F.col(f"_{name}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(name) for name, v in values.items()]
    return joined.select(*[F.col(f"`{c}`") for c in dealt.columns if c != "_range"], *placed)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sizes (source, source_size; one row a source) with weight and target.

    Sources weigh weights in turn, by code point of their names, null last. Together they get share times all words, by weight, but none
    over most times its own; what such a source leaves goes to the others by weight, until none is above. So a target is the lesser of
    most times the source's size and weight times a level that all share. A source of ratio r (its most by its weight) stops
    below the level if at level r the budget isn't used up yet, which a running count by ratio tells.
    """
    session = sizes.sparkSession
    n, words = sizes.agg(F.count(F.lit(1)), F.sum("source_size")).first()
    budget = share * (words or 0)
    named = sizes.select("source", "source_size", F.col("source").isNull().cast("int").alias("_last"), F.lit(1).cast("long").alias("_one"), F.lit(0).alias("_all"))
    placed = running_totals(named, "_all", ["_last", "source"], {"_place": "_one"}, n)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_place") % len(weights) + 1).cast("int")).cast("long")
    rows = placed.select("source", "source_size", "_last", "_all", weight.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("_most"))
    path = fresh_path(session, "weights")
    rows.withColumn("_ratio", F.col("_most") / F.col("weight")).write.parquet(path)
    rows = session.read.parquet(path)
    weigh = rows.agg(F.sum("weight")).first()[0] or 0
    ordered = running_totals(rows, "_all", ["_ratio", "_last", "source"], {"_held": "_most", "_weighed": "weight"}, n)
    stops = F.col("_held") + F.col("_ratio") * (F.lit(weigh) - F.col("_weighed")) <= F.lit(budget)
    path = fresh_path(session, "stops")
    ordered.withColumn("_stops", stops).write.parquet(path)
    ordered = session.read.parquet(path)
    held, weighed = ordered.where("_stops").agg(F.sum("_most"), F.sum("weight")).first()
    level = (budget - (held or 0.0)) / (weigh - (weighed or 0)) if weigh > (weighed or 0) else 0.0
    target = F.when(F.col("_stops"), F.col("_most")).otherwise(F.lit(level) * F.col("weight"))
    return ordered.select("source", "source_size", "weight", target.alias("target"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, carry: Sequence[str] = ()) -> DataFrame:
    """(id, source, size, _key, _tie) of every row, and the columns to carry, written once. _tie tells alike rows apart."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), text.alias("text"))
    made = rows.select(
        "id", "source", words_in(F.col("text")).alias("size"), random_key(F.col("id"), F.col("text"), seed).alias("_key"),
        F.monotonically_increasing_id().alias("_tie"), *carry,
    )
    path = fresh_path(docs.sparkSession, "sized")
    made.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


ORDER = ("_key", "id", "size", "_tie")


def _placed(rows: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """The rows of _sized() with start (words before them in their source), source_size, target, epochs and rest.

    epochs is how often the target takes the source whole, rest what is left of it then, in words.
    """
    session = rows.sparkSession
    path = fresh_path(session, "sources")
    rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).write.parquet(path)
    sizes = session.read.parquet(path)
    n, sources = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    wanted = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0).cast("long")
    path = fresh_path(session, "targets")
    found = targets(sizes.drop("n"), weights, share, most).withColumn("epochs", epochs)
    found.withColumn("rest", wanted - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "_source").write.parquet(path)
    found = session.read.parquet(path)
    placed = running_totals(rows, "source", ORDER, {"start": "size"}, n or 0)
    if sources <= BROADCAST_ROWS:
        return placed.join(F.broadcast(found), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # sources with many rows are dealt over tasks by row, their one row of targets repeated
    dealt = F.pmod(F.col("_key"), F.lit(64))
    hot = sizes.where(F.col("n") > F.lit(max((n or 0) // 200, 1))).select(F.col("source").alias("_hot"))
    hot = F.broadcast(hot)  # at most 200 rows
    left = placed.join(hot, F.col("source").eqNullSafe(F.col("_hot")), "left").withColumn("_salt", F.when(F.col("_hot").isNotNull(), dealt).otherwise(0).cast("int"))
    spread = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(63))).otherwise(F.array(F.lit(0)))
    right = found.join(hot, F.col("_source").eqNullSafe(F.col("_hot")), "left").withColumn("_of", F.explode(spread))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_of"))
    return left.drop("_hot").join(right.drop("_hot"), same).drop("_source", "_salt", "_of")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 0,
) -> DataFrame:
    """One row per row of docs: id, source, size, source_size, target, start, epochs, taken.

    taken is how many words of the row the mix takes, repeats counted: its size once for each epoch, and in the last, partial
    epoch what of it lies before the source's cut. The rows of a source take exactly the whole words of its target. Which
    rows these are depends on id, text and seed only; of rows that are alike in both any may be the one taken. A null text has no
    words, null is a source like any other, a null id is allowed. Other columns are not read.
    """
    placed = _placed(_sized(docs, id_col, text_col, source_col, seed), weights, share, most)
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start")))
    taken = F.col("epochs") * F.col("size") + last
    return placed.select("id", "source", "size", "source_size", "target", "start", "epochs", taken.cast("long").alias("taken"))


def mixture(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The mix itself: id, source, epoch (from 1), words, text, one row for each epoch in which a row of docs is taken.

    The text at a source's cut is its first words, joined by spaces; all others are whole. Texts are written once and not shuffled:
    a source's cut, the last row it takes in part or whole, is found from keys and numbers alone.
    """
    session = docs.sparkSession
    rows = _sized(docs, id_col, text_col, source_col, seed, ["text"])
    placed = _placed(rows.drop("text"), weights, share, most)
    # the row in which rest ends; a source without one has rest 0
    ends = placed.where((F.col("rest") > F.col("start")) & (F.col("rest") <= F.col("start") + F.col("size")))
    cuts = placed.groupBy("source").agg(F.first("epochs").alias("epochs")).withColumnRenamed("source", "_source")
    ends = ends.select(F.col("source").alias("_end"), F.struct(*ORDER).alias("_cut"), (F.col("rest") - F.col("start")).alias("_words"))
    path = fresh_path(session, "cuts")
    cuts.join(ends, F.col("_source").eqNullSafe(F.col("_end")), "left").drop("_end").write.parquet(path)
    cuts = session.read.parquet(path)
    joined = rows.where("size > 0").join(_small(cuts, cuts.count()), F.col("source").eqNullSafe(F.col("_source")))
    here = F.struct(*ORDER)
    partial = F.when(F.col("_cut").isNull() | (here > F.col("_cut")), 0).when(here == F.col("_cut"), F.col("_words")).otherwise(F.col("size"))
    whole = F.transform(F.sequence(F.lit(1), F.col("epochs")), lambda e: F.struct(e.cast("int").alias("epoch"), F.col("size").alias("words")))
    whole = F.when(F.col("epochs") > 0, whole).otherwise(F.array().cast("array<struct<epoch:int,words:bigint>>"))
    last = F.array(F.struct((F.col("epochs") + 1).cast("int").alias("epoch"), F.col("partial").alias("words")))
    parts = F.when(F.col("partial") > 0, F.concat(whole, last)).otherwise(whole)
    taken = joined.withColumn("partial", partial.cast("long")).select("id", "source", "size", "text", F.explode(parts).alias("_part"))
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), 1, F.col("_part.words").cast("int")), " ")
    text = F.when(F.col("_part.words") == F.col("size"), F.col("text")).otherwise(first)
    return taken.select("id", "source", "_part.epoch", "_part.words", text.alias("text"))
