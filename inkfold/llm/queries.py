"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.llm import ann, bpe, decontaminate, extract, lm, mixing, periods, simhash, tokenbin, toxicity, urlfilter, warc, whitening
from inkfold.llm.common import bound_batches, fresh_path, table

#: What a host of listed pages has in its name. Fixed values.
LISTED_HOSTS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
#: Fixed values.
RULES = [
    urlfilter.Rule("block", "net", "/"),
    urlfilter.Rule("allow", "example.net", "/en/"),
    urlfilter.Rule("block", "example.com", "/de/"),
    urlfilter.Rule("allow", "org", "/fr/"),
]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return extract.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select(
        F.col("id").alias("doc_id"),
        toxicity.held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = table(spark, sf_dir, "documents")
    scored = lm.score(docs, docs.where(~lm.held_out(F.col("doc_id"))))
    return scored.withColumnRenamed("id", "doc_id").withColumn("held_out", lm.held_out(F.col("doc_id")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.captures(warc.read_archives(spark, path, with_payload=False))
    return found.select(
        "page_id",
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        "refers_to",
    )


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    path = fresh_path(spark, "token-ids")
    tokenbin.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), path)
    found = tokenbin.read_tokens(spark, path, with_ids=False)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed: the canonical URLs of all pages on hosts named in LISTED_HOSTS, and those that several pages have."""
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select(urlfilter.host_of(F.col("url")).alias("host"), urlfilter.path_of(F.col("url")).alias("path"))
    named = F.max(F.col("host").rlike("(?:" + "|".join(LISTED_HOSTS) + ")"))
    urls = hosts.groupBy(urlfilter.canonical(F.col("host"), F.col("path")).alias("url"))
    listed = urls.agg(named.alias("named"), F.count(F.lit(1)).alias("n")).where("named OR n > 1").select("url")
    return urlfilter.judge(pages, listed, RULES).withColumnRenamed("id", "page_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    path = tokenizer_path("word_bpe_49k.json")
    found = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deviation is NULL where it lies beyond the longs."""
    bound_batches(spark)
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), 4)
    deviation = F.col("deviation").try_cast("long").alias("deviation")
    return found.select(F.col("id").alias("vec_id"), "component", "n", deviation, "whitened", "explained", "identity_error")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document the longest run, ties to the smaller start, then period."""
    bound_batches(spark)
    found = periods.periodic_runs(table(spark, sf_dir, "documents"), periods.planted, with_text=False)
    by_length = F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")))
    best = found.withColumn("best", F.array_max(by_length))
    return best.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_html": op2_html,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_language_model": op5_language_model,
    "op6_decontaminate": op6_decontaminate,
    "op7_warc": op7_warc,
    "op8_token_ids": op8_token_ids,
    "op9_url_filter": op9_url_filter,
    "op10_bpe": op10_bpe,
    "op11_whitening": op11_whitening,
    "op12_mixing": op12_mixing,
    "op13_periodic_runs": op13_periodic_runs,
}

_HOST = r"translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1)"

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op6_decontaminate": f"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS words FROM documents
), b AS (
  SELECT item_id, words, least(13, len(words)) AS n FROM (SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0
), w AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM b)
), g AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM w))
), h AS (
  SELECT doc_id, i, n, item_id FROM g JOIN w USING (n, gram)
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM h) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id
), made AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256
  FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
)
SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM made
""",
    "op7_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(encode(coalesce(html, ''))) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
""",
    "op9_url_filter": f"""
WITH parsed AS (
  SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages
), keyed AS (
  SELECT *, regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '(/|[.]html)$', '') AS key FROM parsed
), bad AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(*) > 1 OR bool_or(regexp_matches(host, '{"|".join(LISTED_HOSTS)}'))
), ruled AS (
  SELECT keyed.*, bad.key IS NOT NULL AS listed,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM keyed LEFT JOIN bad USING (key)
)
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
       WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""",
    "op12_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(concat_ws(':', '0', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, 2.0 * CAST(source_size AS DOUBLE) AS most, 2.0 * CAST(source_size AS DOUBLE) / weight AS ratio FROM s
), t AS (
  SELECT CAST(1.5 AS DOUBLE) * CAST(sum(source_size) AS DOUBLE) AS budget, CAST(sum(weight) AS BIGINT) AS weigh FROM s
), o AS (
  SELECT r.*, budget, weigh,
    coalesce(sum(most) OVER w, 0) + ratio * (weigh - coalesce(CAST(sum(weight) OVER w AS BIGINT), 0)) <= budget AS stops
  FROM r CROSS JOIN t WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT (max(budget) - coalesce(sum(most) FILTER (stops), 0)) / CAST(sum(weight) FILTER (NOT stops) AS DOUBLE) AS level FROM o
), g AS (
  SELECT source, source_size, CASE WHEN stops THEN most ELSE level * weight END AS target FROM o CROSS JOIN l
), p AS (
  SELECT d.*, source_size, target, CAST(floor(target) AS BIGINT) AS wanted,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
  (wanted // source_size) * size + greatest(0, least(size, wanted % source_size - before)) END AS BIGINT) AS taken
FROM p
""",
}
