"""URL filters: host and path rules, and a list of URLs behind a blocked Bloom filter. DataFrame functions only.

The filter is a table (block, bits): a listed canonical URL sets a few bits in the one 64-bit block its hash names. A page
joins its block; only URLs whose bits are all set go on to an exact hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.llm.common import hot_keys

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Listed URLs for each block of 64 bits, and bits that each of them sets: about one false hit in 70.
URLS_PER_BLOCK = 6
BITS_PER_URL = 5
#: Blocks up to which the filter (20 bytes a block) is broadcast; a larger one is joined by shuffle.
BROADCAST_BLOCKS = 400_000


@dataclass(frozen=True)
class Rule:
    """verdict for a host with all its subdomains, where the path starts with path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or no ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What stands between the host and ?, # or the end; empty for null or no ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """A URL without scheme, query and fragment, without www. and m., and without a slash or .html at the end."""
    return F.concat(
        F.regexp_replace(host, r"\A(?:www|m)\.", ""), F.regexp_replace(path, r"(?:/|\.html)\z", "")
    )


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The fitting rule with the longest name as a struct (name, verdict), or null. Rules are a short list of the caller's."""
    chosen = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bits(url: Column) -> Column:
    """The bits of a URL in its block, six bits of a second hash for each."""
    second = F.xxhash64(url, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(BITS_PER_URL):
        place = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def bloom_blocks(listed: DataFrame, blocks: int, url_col: str = "url") -> DataFrame:
    """The filter of distinct or repeated canonical URLs: one row (block, bits) for each block with a URL."""
    named = listed.where(F.col(url_col).isNotNull())
    return (
        named.groupBy(_block(F.col(url_col), blocks).alias("block")).agg(F.bit_or(_bits(F.col(url_col))).alias("bits"))
    )


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
    listed_verdict: str = "block",
    other_verdict: str = "allow",
) -> DataFrame:
    """One row per row of pages: id, host, path, rule (its name or null), listed (boolean), verdict.

    The verdict is that of the fitting rule; without one, listed_verdict if the canonical URL is in listed, else
    other_verdict. A null URL and one without :// have empty host and path and are never listed. Null and
    repeated entries of the list do no harm. Repeated pages stay repeated. Other columns are not read.
    """
    urls = listed.select(F.col(listed_col).cast("string").alias("key")).where("key <> ''").distinct()
    n = urls.count()
    blocks = max(1, -(-n // URLS_PER_BLOCK))
    bloom = bloom_blocks(urls, blocks, "key")
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("key", canonical(F.col("host"), F.col("path"))).withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    # URLs of very many pages, at most HOT_SHARES, are looked up here and now; they and pages without a URL meet no other row below
    hot = hot_keys(rows.where("key <> ''").groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key")
    hot_listed = [r[0] for r in urls.where(F.col("key").isin(hot)).collect()] if hot else []
    apart = (F.col("key") == "") | F.col("key").isin(hot)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    if blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)
    block = F.when(apart, -1 - F.col("row")).otherwise(_block(F.col("key"), blocks))
    probed = rows.withColumn("block", block).join(bloom, "block", "left")
    mask = _bits(F.col("key"))
    probed = probed.withColumn("possible", F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False)))
    # a page without a possible hit gets a key of its own that no URL has, so that such pages spread over the tasks
    probe = F.when(F.col("possible"), F.col("key")).otherwise(F.concat(F.lit("\x00"), F.col("row").cast("string")))
    found = probed.withColumn("probe", probe).join(
        urls.select(F.col("key").alias("probe"), F.lit(True).alias("hit")), "probe", "left"
    )
    is_listed = F.coalesce(F.col("hit"), F.lit(False)) | F.col("key").isin(hot_listed)
    fallback = F.when(is_listed, F.lit(listed_verdict)).otherwise(F.lit(other_verdict))
    return found.select(
        "id", "host", "path", F.col("rule.name").alias("rule"), is_listed.alias("listed"), F.coalesce(F.col("rule.verdict"), fallback).alias("verdict")
    )
