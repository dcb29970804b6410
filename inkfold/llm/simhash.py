"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints that differ in at most tau bits, cut into m parts whose thresholds t_i add up to tau - m + 1, differ in at
most t_i bits in some part i (-1 leaves a part out). Correlated bits are put into one part, and a dynamic
programme gives each part its threshold by the candidates it is estimated to make. A part with threshold t is probed
by leaving out every choice of t of its bits: fingerprints within t bits there share one of these keys.

Only the plan (parts, thresholds) comes from a sample; whatever the plan, every link is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.common import bounded_sample, connected, cut, hot_keys, map_batches, salted_join

SEED = 42
BITS = 64
#: Distinct fingerprints, chosen by hash, on which the plan is made.
PLAN_SAMPLE = 2048
#: Rows of one bucket that a task compares; larger buckets are split into tiles that meet pairwise.
TILE = 16384
#: Groups up to this size are compared all at once, larger ones by walking from fingerprint to fingerprint.
SMALL_GROUP = 48
_HASHES = 1 << 17


def text_hashes(text: str | None, words: int) -> list[int]:
    """XXH64 of every shingle of so many words, repeats included; of the whole sequence if it is shorter."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return []
    line = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(line, SEED)]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    one = xxhash.xxh64_intdigest
    return [one(line[a:b], SEED) for a, b in zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For consecutive groups of hashes: the bits set in over half of the group. An empty group gives zero."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    sizes = sizes[full]
    pieces = -(-sizes // 255)  # a byte counts to 255
    first = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    within = np.arange(pieces.sum()) - np.repeat(first, pieces)
    cuts = np.repeat(begin, pieces) + 255 * within
    got = np.zeros(len(full), np.uint64)
    for j in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & np.uint64(0x0101010101010101), cuts)
        counts = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for byte in range(8):
            got |= (2 * counts[:, byte] > sizes).astype(np.uint64) << np.uint64(8 * byte + j)
    out[full] = got
    return out


def _fingerprints(texts: pa.Array, words: int) -> np.ndarray:
    made, sizes, hashes = [], [], []
    for text in texts:
        own = text_hashes(text.as_py(), words)
        sizes.append(len(own))
        hashes += own
        if len(hashes) > _HASHES:
            made.append(majority(np.array(hashes, np.uint64), np.array(sizes)))
            sizes, hashes = [], []
    made.append(majority(np.array(hashes, np.uint64), np.array(sizes, np.int64)))
    return np.concatenate(made).view(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """One row (id, fp) per row of docs; fp is the 64-bit fingerprint as a long. A null or blank text has fingerprint 0."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([rows.column(0), pa.array(_fingerprints(rows.column(1), words))], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, batch, "id long, fp long")


def group_bits(bits: np.ndarray, m: int) -> list[list[int]]:
    """The bit positions in m parts of like size, bits that go together in one part. bits: one row per fingerprint."""
    with np.errstate(all="ignore"):
        tied = np.abs(np.nan_to_num(np.corrcoef(bits.T))) if len(bits) > 1 else np.zeros((BITS, BITS))
    left, parts = list(range(BITS)), []
    for k in range(m):
        room = -(-len(left) // (m - k))
        part = [max(left, key=lambda b: (tied[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < room:
            best = max(left, key=lambda b: (tied[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def allot(costs: list[dict[int, float]], total: int) -> list[int]:
    """Thresholds, one per part, that add up to total at the least cost. costs: by part, cost of each threshold."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, more in part.items():
                at = spent + t
                if at not in after or cost + more < after[at][0]:
                    after[at] = (cost + more, [*chosen, t])
        best = after
    return best[total][1]


def make_plan(sample: np.ndarray, n: int, tau: int) -> list[tuple[list[int], int]]:
    """Parts (bit positions) with their thresholds for n distinct fingerprints, of which sample (uint64) is a part."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    scale = (n / max(len(sample), 1)) ** 2
    found, least = None, np.inf
    for m in range(2, tau + 2):
        parts, costs = group_bits(bits, m), []
        for part in parts:
            cost = {-1: 0.0}
            apart = _distance_counts(bits[:, part])
            for t in range(min(tau, 2, len(part)) + 1):
                meets = sum(apart[d] * comb(len(part) - d, t - d) for d in range(min(t, len(apart) - 1) + 1))
                cost[t] = 60.0 * n * comb(len(part), t) + scale * meets
            costs.append(cost)
        try:
            chosen = allot(costs, tau - m + 1)
        except KeyError:
            continue
        price = sum(c[t] for c, t in zip(costs, chosen, strict=True))
        if price < least:
            found, least = [(p, t) for p, t in zip(parts, chosen, strict=True) if t >= 0], price
    return found


def _distance_counts(bits: np.ndarray) -> np.ndarray:
    """How many pairs of rows differ in 0, 1, 2, ... places."""
    ones = bits.sum(1)
    apart = (ones[:, None] + ones[None, :] - 2 * bits @ bits.T).astype(np.int64)
    return np.bincount(apart[np.triu_indices(len(bits), 1)], minlength=bits.shape[1] + 1)


def bucket_entries(distinct: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """One row (bucket, fp, id) for each key of each (fp, id): part, left-out bits and the rest of the part's bits."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        fp = rows.column(0).to_numpy(zero_copy_only=False)
        keys, number = [], 0
        for part, t in plan:
            for out in combinations(range(len(part)), t):
                key = np.zeros(len(fp), np.int64)
                for k, b in enumerate(x for i, x in enumerate(part) if i not in out):
                    key |= ((fp >> b) & 1) << k
                keys.append(key | (number << 40))
                number += 1
        n = len(keys)
        return pa.record_batch(
            [pa.array(np.concatenate(keys)), pa.array(np.tile(fp, n)), pa.array(np.tile(rows.column(1).to_numpy(zero_copy_only=False), n))],
            ["bucket", "fp", "id"],
        )

    return map_batches(distinct.select("fp", "id"), batch, "bucket long, fp long, id long")


def _small_links(group: np.ndarray, fp: np.ndarray, ids: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within sorted groups by comparing each row with the next, the one after, and so on."""
    a, b, shift = [], [], 1
    while True:
        at = np.flatnonzero(group[shift:] == group[:-shift]) if shift < len(group) else np.empty(0, int)
        if not len(at):
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + shift]) <= tau]
        a.append(ids[at])
        b.append(ids[at + shift])
        shift += 1
    return (np.concatenate(a), np.concatenate(b)) if a else (ids[:0], ids[:0])


def _walk_links(fp: np.ndarray, ids: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one group: each fingerprint reached is compared with those not yet reached only."""
    links, left = [], np.arange(len(fp))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[here]) <= tau
            if near.any():
                reached = left[near]
                links += [(ids[here], x) for x in ids[reached].tolist()]
                queue.extend(reached.tolist())
                left = left[~near]
    return links


def _local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one link from each id to the least of its component."""
    names, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y, low = flat[: len(a)], flat[len(a) :], np.arange(len(names))
    while True:
        least = np.minimum(low[x], low[y])
        after = low.copy()
        np.minimum.at(after, low[x], least)
        np.minimum.at(after, low[y], least)
        after = after[after]
        if (after == low).all():
            break
        low = after
    away = np.flatnonzero(low != np.arange(len(names)))
    return names[away], names[low[away]]


def bucket_links(entries: DataFrame, tau: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) of ids whose fingerprints share a bucket and differ in at most tau bits, as spanning forests.

    A bucket over tile rows is cut into chunks by a hash of the fingerprint, and every two chunks meet in a task of their
    own, so that no task holds more than about two chunks of one bucket.
    """
    counted = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = cut(counted.where(F.col("n") > tile))
    tiled = entries.withColumn("tile", F.lit(0))
    if large.count():
        k = F.ceil(F.coalesce(F.col("n"), F.lit(0)) / tile).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.greatest(F.col("k"), F.lit(1))).cast("int")
        other = F.explode(F.when(F.col("k") < 2, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("k") - 1)))
        joined = entries.join(large, "bucket", "left").withColumn("k", k).withColumn("own", own).withColumn("other", other)
        tiled = joined.select("bucket", "fp", "id", (F.least("own", "other") * 1048576 + F.greatest("own", "other")).alias("tile"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for rows in batches:
            new = [rows.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            kept = new if kept is None else [np.concatenate((x, y)) for x, y in zip(kept, new, strict=True)]
            bucket, tile_no = kept[0], kept[1]
            change = np.flatnonzero((bucket[1:] != bucket[:-1]) | (tile_no[1:] != tile_no[:-1]))
            if len(change):
                end = change[-1] + 1
                yield _links([x[:end] for x in kept], tau)
                kept = [x[end:] for x in kept]
        if kept is not None and len(kept[0]):
            yield _links(kept, tau)

    dealt = tiled.select("bucket", "tile", "fp", "id").repartition("bucket", "tile").sortWithinPartitions("bucket", "tile", "fp", "id")
    return dealt.mapInArrow(run, "a long, b long")


def _links(columns: list[np.ndarray], tau: int) -> pa.RecordBatch:
    bucket, tile_no, fp, ids = columns
    fp = fp.view(np.uint64)  # bitwise_count takes the absolute value of signed numbers
    starts = np.concatenate(([0], np.flatnonzero((bucket[1:] != bucket[:-1]) | (tile_no[1:] != tile_no[:-1])) + 1))
    sizes = np.diff(np.concatenate((starts, [len(bucket)])))
    group = np.repeat(np.arange(len(starts)), sizes)
    small = np.repeat(sizes <= SMALL_GROUP, sizes)
    a, b = _small_links(group[small], fp[small], ids[small], tau)
    walked = [x for s, n in zip(starts, sizes, strict=True) if n > SMALL_GROUP for x in _walk_links(fp[s : s + n], ids[s : s + n], tau)]
    if walked:
        more = np.array(walked, np.int64)
        a, b = np.concatenate((a, more[:, 0])), np.concatenate((b, more[:, 1]))
    a, b = _local_stars(a, b)
    return pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, tau: int = 4
) -> DataFrame:
    """One row per row of docs: id, fp (long), component_id (the least id reachable over links of at most tau bits).

    Null and blank texts have fingerprint 0 and are linked like any other. A null id takes part in no link and has a null
    component. Repeated rows stay repeated. An empty table gives an empty result. Other columns of docs are not read.
    """
    marked = cut(fingerprints(docs, id_col, text_col, words))
    groups = cut(marked.groupBy("fp").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")))
    parts = _components(groups.where("rep IS NOT NULL").select("fp", F.col("rep").alias("id")), tau)
    named = groups.join(parts, groups.rep == parts.id, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    hot = hot_keys(groups.select("fp", "n"), "fp")
    found = salted_join(marked, named, "fp", hot, "id")
    return found.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def _components(distinct: DataFrame, tau: int) -> DataFrame:
    """One row (id, component) for each id of distinct (fp, id) that is linked to another one."""
    n = distinct.count()
    if n < 2:
        return distinct.select("id", F.col("id").alias("component"))
    sample = sorted(r[0] for r in bounded_sample(distinct, ["fp"], PLAN_SAMPLE, n).select("fp").collect())
    plan = make_plan(np.array(sample, np.int64).view(np.uint64), n, tau)
    return connected(bucket_links(bucket_entries(distinct, plan), tau))


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, tau: int = 4
) -> DataFrame:
    """Of each group of linked fingerprints one row of docs, all columns as they are: the one with the least id.

    Links are between fingerprints, so that rows of one id, or without an id, are copies only if their texts are. A null id
    comes after all others; ties go by fingerprint, hash of the text and hash of the row, so that a task run again
    chooses alike.
    """
    value = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]  # xxhash64 passes over nulls
    keyed = docs.select("*", F.xxhash64(F.col(text_col)).alias("_mark"), F.xxhash64(*value).alias("_row"))

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([*rows.columns[:3], pa.array(_fingerprints(rows.column(3), words))], ["id", "mark", "row", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = keyed.select(F.col(id_col).alias("id"), F.col("_mark").alias("mark"), F.col("_row").alias("row"), F.col(text_col).cast("string"))
    marked = map_batches(texts, batch, f"id {kind}, mark long, row long, fp long")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "fp", "mark", "row")
    groups = cut(marked.groupBy("fp").agg(F.min(order).alias("least")))
    parts = _components(groups.select("fp", F.col("fp").alias("id")), tau)
    named = groups.join(parts, groups.fp == parts.id, "left").groupBy(F.coalesce("component", "fp")).agg(F.min("least").alias("least"))
    kept = named.select(F.col("least.mark").alias("_mark"), F.col("least.row").alias("_row"))
    return keyed.dropDuplicates(["_mark", "_row"]).join(kept, ["_mark", "_row"], "left_semi").select(*(f"`{c}`" for c in docs.columns))
