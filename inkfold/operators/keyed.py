"""Inner joins on a note key that hold up at any size and under any skew.

A side is broadcast only when its rows and bytes have been measured to be within a fixed limit. Past it both
sides are shuffled; one pass over the key columns finds hot keys, whose rows are spread over several tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side sent to every executor, as bytes of its values before row overhead.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows beyond which a side is not broadcast.
BROADCAST_ROWS = 2_000_000

UNBOUNDED = 2**63 - 1

# A key is hot when it has more rows than this many tasks would share evenly.
HOT_SHARES = 2
# Candidates that the sketch of frequent keys tracks for each task, and at least. Limits of the sketch itself: it reports
# TOP_LIMIT keys of TRACKED_LIMIT candidates, enough for all hot keys of 125,000 tasks. A key it misses is not lost, only not spread.
TRACKED_PER_TASK, LEAST_TRACKED = 8, 16384
TOP_LIMIT, TRACKED_LIMIT = 100_000, 1_000_000

# So many keys are named in the filter of the scan, in groups that Parquet compares one by one rather than as a range.
FEW_KEYS, KEY_GROUP = 256, 10

# A filter of keys has blocks of eight 64-bit words for so many keys each, sixteen bits a key, and at most so many blocks, some 50 MB; with
# FULL times as many keys as fit them well it still drops most other keys, with more it is not built.
BLOCK_KEYS, MOST_BLOCKS, FULL = 32, 1 << 18, 4
# A side is filtered by the other side's keys where these are at most one for so many of its rows.
FILTER_SHARE = 2

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
_VARYING = (T.StringType, T.BinaryType)

_PARTS = "__parts"


@dataclass(frozen=True)
class Profile:
    """Rows of a side, the bytes of its values, those of its widest row, and its most frequent keys with their row counts.

    Bytes are unbounded where a type does not bound them. With up to ``FEW_KEYS`` rows the keys are all of them.
    """

    rows: int
    size: int
    widest: int
    top: tuple[tuple[object, int], ...] = ()

    def times(self, other: Profile) -> Profile:
        """Bounds for the rows of this side, each joined with those of its key in ``other``."""
        repeats = max((n for _, n in other.top), default=1)
        rows = self.rows * repeats
        unbounded = UNBOUNDED in (self.size, other.size)
        widest = UNBOUNDED if unbounded else self.widest + other.widest
        return Profile(rows, UNBOUNDED if unbounded else rows * widest, widest, tuple((k, n * repeats) for k, n in self.top))

    def plus(self, other: Profile) -> Profile:
        """Bounds for the rows of both."""
        top = Counter(dict(self.top)) + Counter(dict(other.top))
        return Profile(
            self.rows + other.rows,
            min(self.size + other.size, UNBOUNDED),
            max(self.widest, other.widest),
            tuple(top.most_common()),
        )


def _partitions(side: DataFrame) -> int:
    return int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def profile(side: DataFrame, key: str | None = None) -> Profile:
    """Everything the choice of a join needs to know of a side, in one aggregation without a shuffle of its rows."""
    types = [field.dataType for field in side.schema]
    bounded = not any(isinstance(dtype, _NESTED) for dtype in types)
    varying = [F.octet_length(side[f"`{f.name}`"]) for f in side.schema if isinstance(f.dataType, _VARYING)]
    lengths = [F.coalesce(length, F.lit(0)).cast("bigint") for length in varying] if bounded else []
    row = reduce(Column.__add__, lengths, F.lit(8 * len(types)).cast("bigint"))
    values = [F.count(F.lit(1)), F.sum(row), F.max(row)]
    if key is not None:
        partitions = _partitions(side)
        tracked = min(max(LEAST_TRACKED, TRACKED_PER_TASK * partitions), TRACKED_LIMIT)
        top = min(max(FEW_KEYS, -(-partitions // HOT_SHARES)), TOP_LIMIT)
        values.append(F.expr(f"approx_top_k(`{key}`, {top}, {tracked})"))
    found = side.agg(*values).first()
    rows, size, widest = found[0], found[1] or 0, found[2] or 0
    if not bounded and rows:
        size = widest = UNBOUNDED
    items = (found[3] or ()) if key is not None else ()
    return Profile(rows, size, widest, tuple((item["item"], item["count"]) for item in items))


def listed_profile(values: Iterable) -> Profile:
    """The profile of a driver-side list of keys with their positions, without a job."""
    counts = Counter(v for v in values if v is not None)
    width = {v: 16 + (len(v.encode()) if isinstance(v, str) else 0) for v in counts}
    rows, size = sum(counts.values()), sum(width[v] * n for v, n in counts.items())
    return Profile(rows, size, max(width.values(), default=0), tuple(counts.most_common()))


def fits(side: Profile, limit: int) -> bool:
    """Whether a side may be broadcast."""
    return side.rows <= BROADCAST_ROWS and side.size <= limit


def few_keys(side: Profile) -> list | None:
    """All keys of a side of few rows; ``None`` for any other."""
    return [key for key, _ in side.top if key is not None] if side.rows <= FEW_KEYS else None


def narrowed(side: DataFrame, key: str, keys: Iterable) -> DataFrame:
    """Rows of ``side`` with one of few keys, as a condition that reaches the scan: a file or row group without
    any of the keys is not read at all."""
    values = sorted(keys)
    groups = [values[at : at + KEY_GROUP] for at in range(0, len(values), KEY_GROUP)]
    return side.where(reduce(Column.__or__, [F.col(f"`{key}`").isin(group) for group in groups], F.lit(False)))


def _bits(key: Column, blocks: int) -> tuple[Column, Column, Column]:
    """The block of a key, the word within it, and four bits of that word."""
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    places = [F.shiftrightunsigned(second, at).bitwiseAND(63).cast("int") for at in (0, 6, 12, 18)]
    bit = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]
    word = F.shiftrightunsigned(first, 40).bitwiseAND(7).cast("int")
    return F.pmod(first, F.lit(blocks)).cast("int"), word, reduce(Column.bitwiseOR, bit)


def filter_pays(keys: Profile, side: Profile) -> bool:
    """Whether a filter of the keys of one side is small enough, and leaves out enough of the other side's rows, to be built."""
    return keys.rows * FILTER_SHARE <= side.rows and keys.rows <= BLOCK_KEYS * MOST_BLOCKS * FULL


def filtered_by_keys(side: DataFrame, keys: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of ``side`` whose key is among those of ``keys`` (``rows`` of them), and a few others.

    A blocked Bloom filter of the keys is built by an aggregation and broadcast; its size is bounded, that of the keys need not be. It is probed
    where the side is read, so that rows without a partner are not shuffled. The join that follows drops the others.
    """
    blocks = min(max(-(-rows // BLOCK_KEYS), 1), MOST_BLOCKS)
    block, word, bits = _bits(F.col(f"`{key}`").cast(side.schema[key].dataType), blocks)
    marks = keys.select(block.alias("__block"), word.alias("__word"), bits.alias("__bits"))
    words = [F.bit_or(F.when(F.col("__word") == n, F.col("__bits")).otherwise(F.lit(0).cast("bigint"))) for n in range(8)]
    built = marks.groupBy("__block").agg(F.array(*words).alias("__words"))
    block, word, bits = _bits(side[f"`{key}`"], blocks)
    return side.join(F.broadcast(built), (block == F.col("__block")) & (F.get("__words", word).bitwiseAND(bits) == bits), "left_semi")


def hot_salts(side: Profile, partitions: int) -> dict[object, int]:
    """Tasks to spread each hot key over, so that none of them gets more than an even share.

    Together these are at most ``partitions`` and one per hot key, which bounds the repeated notes.
    """
    return {
        key: -(-count * partitions // side.rows)
        for key, count in side.top
        if key is not None and count * partitions > HOT_SHARES * side.rows
    }


def _salt_frame(side: DataFrame, key: str, salts: dict[object, int]) -> DataFrame:
    """The hot keys and their number of parts, a frame of at most one row for each two tasks."""
    table = pa.table({key: pa.array(list(salts)), _PARTS: pa.array(list(salts.values()), pa.int32())})
    frame = side.sparkSession.createDataFrame(table)
    return F.broadcast(frame.withColumn(key, F.col(f"`{key}`").cast(side.schema[key].dataType)))


def _spread_columns(side: DataFrame) -> list[str]:
    """Columns that tell the rows of a side apart. Contents are left out: hashing them costs and adds nothing."""
    return [f.name for f in side.schema if not isinstance(f.dataType, (*_NESTED, T.BinaryType))]


def _in_one_part(side: DataFrame, key: str, hot: DataFrame, salt: str, spread_by: list[str]) -> DataFrame:
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in spread_by])
    part = F.pmod(row_hash, F.coalesce(F.col(_PARTS), F.lit(1))).cast("int")
    return side.join(hot, key, "left").withColumn(salt, part).drop(_PARTS)


def _in_all_parts(side: DataFrame, key: str, hot: DataFrame, salt: str) -> DataFrame:
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1))
    return side.join(hot, key, "left").withColumn(salt, parts).drop(_PARTS)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_salts: dict[object, int],
    right_salts: dict[object, int] | None = None,
    how: str = "inner",
    hashed: str = "",
) -> DataFrame:
    """Inner (or, with the left side salted alone, left) join in which the rows of hot keys are split into parts by a hash of the row.

    The matching rows of the other side are repeated once per part, so that every pair of rows meets exactly
    once, also where both sides are hot. The hash depends on the row alone: a task that is run again after
    an executor is lost sends every row to the same part. ``hashed`` names the side (left or right) whose rows of a task fit in memory:
    the other side streams past it unsorted.
    """
    on = [key]
    spread_left, spread_right = _spread_columns(left), _spread_columns(right)
    if left_salts:
        hot = _salt_frame(left, key, left_salts)
        left = _in_one_part(left, key, hot, "__left_part", spread_left)
        right = _in_all_parts(right, key, hot, "__left_part")
        on.append("__left_part")
    if right_salts:
        hot = _salt_frame(right, key, right_salts)
        left = _in_all_parts(left, key, hot, "__right_part")
        right = _in_one_part(right, key, hot, "__right_part", spread_right)
        on.append("__right_part")
    left = left.hint("shuffle_hash") if hashed == "left" else left
    right = right.hint("shuffle_hash") if hashed == "right" else right
    return left.join(right, on, how).drop(*on[1:])


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_profile: Profile,
    right_profile: Profile | None = None,
    how: str = "inner",
    hashed: str = "",
) -> DataFrame:
    """Shuffled join; salted only where a side has hot keys, so that bucketed tables whose keys are even
    still join without a shuffle. A side without a profile has unique keys."""
    partitions = _partitions(left)
    left_salts = hot_salts(left_profile, partitions)
    right_salts = hot_salts(right_profile, partitions) if right_profile else {}
    return salted_join(left, right, key, left_salts, right_salts, how, hashed)


def first_rows(
    rows: DataFrame,
    key: str,
    place: str | None,
    slots: dict[str, Column],
    parts: Iterable[str],
    limit: int = BROADCAST_BYTES,
    clustered: bool = False,
    bound: Profile | None = None,
) -> DataFrame:
    """One row per key with a struct of ``parts`` in each slot: those of the row with the least ``place`` of all that meet the
    slot's condition, NULL where none does. Conditions exclude one another; of several rows at one place the least counts.

    Places are found first, by an aggregation that reads no other column. Parts, which may be large, are then looked up by
    them: a row that is no key's first is dropped where it is read if the places can be broadcast, else by a hash join that holds places only. Parts
    are gathered by a hash aggregation, which spills by itself where a task has many keys; the plan sorts none. Hot keys are spread for the lookup, after which a key has a row for each slot.
    ``clustered`` rows are bucketed by ``key``. ``bound``, where known, is a profile of more rows than there are keys, and saves measuring.
    """
    order, number = F.lit(0) if place is None else F.col(f"`{place}`"), range(len(slots))
    kept = rows.where(reduce(Column.__or__, slots.values()))
    places = kept.groupBy(key).agg(*[F.min(F.when(met, order)).alias(f"__place_{n}") for n, met in zip(number, slots.values())])
    if clustered:
        placed = kept.join(places, key)
    else:
        of_rows = bound or profile(kept.select(key), key)
        if fits(replace(of_rows, size=of_rows.size + 16 * len(slots) * of_rows.rows), limit):
            placed = kept.join(F.broadcast(places), key)
        else:
            of_rows = of_rows if bound is None else profile(kept.select(key), key)
            placed = salted_join(kept, places, key, hot_salts(of_rows, _partitions(rows)), hashed="right")
    slot = F.coalesce(*[F.when(met & (order == F.col(f"__place_{n}")), F.lit(n)) for n, met in zip(number, slots.values())])
    found = placed.select(key, slot.alias("__slot"), F.struct(*[F.col(f"`{c}`") for c in parts]).alias("__parts"))
    gathered = found.where("__slot IS NOT NULL").groupBy(key).agg(F.collect_set(F.struct("__slot", "__parts")).alias("__rows"))

    def least(n: int) -> Column:
        return F.array_min(F.filter("__rows", lambda row: row["__slot"] == n))["__parts"]

    return gathered.select(key, *[least(n).alias(name) for n, name in zip(number, slots)])
