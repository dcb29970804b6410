"""Putting rows in order without computing them twice."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PART = "__part"


def in_order(rows: DataFrame, places: DataFrame, by: list[str], order: Iterable[str]) -> DataFrame:
    """``rows`` by ``order``, whose first columns are ``by``, over the session's number of shuffle partitions.

    A range sort samples what it sorts, which computes it twice. Here ``places``, cheap rows with the columns ``by``, tell where each
    partition begins: they are ranged by themselves, and the least of each range comes to the driver, one value a partition. Every row then finds
    its partition by bisection. Rows of equal ``by`` stay together.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*by)
    ranged = places.select(*by).repartitionByRange(parts, *by).select(place.alias("first"))
    firsts = [r[0] for r in ranged.groupBy(F.spark_partition_id()).agg(F.min("first").alias("first")).select("first").collect()]
    fields = places.select(*by).schema
    starts = rows.sparkSession.createDataFrame([tuple(first) for first in firsts], fields).agg(F.sort_array(F.collect_list(place)).alias("starts"))
    steps = [1 << n for n in reversed(range(max(len(firsts), 1).bit_length()))]
    found = rows.withColumn("__starts", starts.scalar())
    reached = F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda low, step: F.when((low + step <= len(firsts)) & (F.get("__starts", low + step - 1) <= place), low + step).otherwise(low),
    )
    # Before the first start, which a sample of keys may not hold, is the first partition too.
    dealt = found.withColumn(_PART, F.greatest(reached - 1, F.lit(0))).drop("__starts").repartitionById(parts, _PART)
    return dealt.sortWithinPartitions(*order).drop(_PART)
