"""The given tables read as notes, attachments and key lists."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# An address, a pattern both engines of the check understand.
EMAIL = "[A-Za-z0-9._]+@[A-Za-z0-9.]+"


def addresses(text: str) -> Column:
    """All addresses in a text, mostly none."""
    found = F.regexp_extract_all(text, F.lit(f"({EMAIL})"))
    return F.when(F.contains(text, F.lit("@")), found).otherwise(F.array().cast("array<string>"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unid(key: str) -> Column:
    """A key as a UNID: 32 upper-case hexadecimal digits."""
    return F.lpad(F.hex(key), 32, "0").alias("unid")


def note_id(key: str) -> Column:
    return F.col(key).cast("int").alias("note_id")


def document_notes(spark, sf_dir) -> DataFrame:
    """Documents as notes. ``contacts`` is a multi-value that most notes have empty."""
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        unid("doc_id"),
        note_id("doc_id"),
        "doc_id",
        "source",
        "lang",
        "n_chars",
        F.col("text").alias("body"),
        addresses("text").alias("contacts"),
        F.split("text", "\n").alias("lines"),
    )


def order_notes(spark, sf_dir) -> DataFrame:
    """Orders as notes with their system values."""
    orders = table(spark, sf_dir, "orders")
    hours = F.expr("make_dt_interval(0, CAST(o_custkey % 24 AS INT))")
    return orders.select(
        unid("o_orderkey"),
        note_id("o_orderkey"),
        F.col("o_orderpriority").alias("form"),
        F.col("o_orderdate").alias("created"),
        (F.col("o_orderdate") + hours).alias("added_to_file"),
        (F.col("o_orderdate") + F.expr("INTERVAL '3' DAY")).alias("modified"),
        (F.col("o_orderdate") + F.expr("INTERVAL '4' DAY")).alias("modified_in_file"),
        (F.col("o_orderdate") + F.expr("INTERVAL '400' DAY")).alias("accessed"),
        F.col("o_totalprice").alias("size"),
    )


def customer_notes(spark, sf_dir) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select(unid("c_custkey"), note_id("c_custkey"), "c_name", "c_mktsegment", "c_acctbal")


def part_notes(spark, sf_dir) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select(
        unid("p_partkey"), note_id("p_partkey"), "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )


def turn_attachments(spark, sf_dir) -> DataFrame:
    """Turns of conversation ``n`` as text files attached to note ``n``."""
    turns = table(spark, sf_dir, "conversations")
    name = F.concat(F.lit("turn"), "turn", F.lit("."), "role", F.when(F.col("role") == "user", ".TXT").otherwise(".txt"))
    return turns.select(
        unid("conv_id"),
        F.col("turn").cast("int").alias("att_pos"),
        name.alias("name"),
        F.col("text").cast("binary").alias("content"),
    )


def page_file(url: Column) -> Column:
    """Last segment of a URL's path, such as ``930.html``, ``41`` or nothing."""
    return F.regexp_extract(url, r"([^/?#]*)(?:[?#].*)?$", 1)


def page_notes(spark, sf_dir) -> DataFrame:
    """Pages as notes with a MIME body, whose plain part many pages have empty."""
    pages = table(spark, sf_dir, "pages")
    plain = F.nullif(page_file(F.col("url")), F.lit(""))
    return pages.select(unid("page_id"), "page_id", "url", F.struct(plain.alias("plain"), "html").alias("body"))


def long_items(spark, sf_dir) -> DataFrame:
    """Items of documents and pages one row each. A page belongs to the note of the same number."""
    types = {
        "vals": "array<string>", "numbers": "array<double>", "times": "array<timestamp_ntz>",
        "runs": "array<struct<kind:string,text:string>>", "plain": "string", "html": "string",
    }

    def item(notes, pos, name, kind, **parts):
        found = [f"{parts[part]} AS {part}" if part in parts else f"CAST(NULL AS {kind}) AS {part}" for part, kind in types.items()]
        return notes.selectExpr("unid", f"{pos} AS item_pos", f"'{name}' AS name", f"'{kind}' AS kind", *found)

    documents, pages = document_notes(spark, sf_dir), page_notes(spark, sf_dir)
    items = [
        item(documents, 0, "Source", "text", vals="array(source)"),
        item(documents, 1, "Lang", "text", vals="array(lang)"),
        item(documents, 2, "Body", "text", vals="lines"),
        # A second item of the name, which is not read.
        item(documents, 3, "SOURCE", "text", vals="array(lang)"),
        item(documents, 5, "Size_K", "number", numbers="array(n_chars / 1024, 0D)"),
        item(documents, 6, "Seen", "time", times="array(timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, n_chars))"),
        item(pages, 4, "Page", "mime", plain="body.plain", html="body.html"),
    ]
    return reduce(DataFrame.unionAll, items)


def item_notes(spark, sf_dir) -> DataFrame:
    """A row for each document or page, and one for a note with no item at all."""
    ids = table(spark, sf_dir, "documents").select("doc_id").union(table(spark, sf_dir, "pages").select("page_id")).distinct()
    return ids.union(spark.range(1).select(F.lit(-1).cast("long"))).select(unid("doc_id"), note_id("doc_id"))


def default_notes(spark, sf_dir) -> DataFrame:
    """Orders as the table of notes, with the columns of the default metadata."""
    return order_notes(spark, sf_dir)


def page_attachments(spark, sf_dir) -> DataFrame:
    """The HTML source of each page as a file named after its URL, upper-cased for secure URLs."""
    pages = table(spark, sf_dir, "pages")
    file = page_file(F.col("url"))
    return pages.select(
        unid("page_id"),
        F.lit(0).alias("att_pos"),
        F.when(F.col("url").startswith("https:"), F.upper(file)).otherwise(file).alias("name"),
        F.col("html").cast("binary").alias("content"),
    )


# The characters that Spark writes as their codes in names of folders, and what it writes for none.
_ESCAPED, _NO_VALUE = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]"), "__HIVE_DEFAULT_PARTITION__"


def _folder(column: str, value: str | None) -> str:
    """A folder named by column, as Spark names it."""
    return f"{column}={_ESCAPED.sub(lambda found: f'%{ord(found.group()):02X}', value) if value else _NO_VALUE}"


def put_files(files: DataFrame, path: str) -> None:
    """Writes ``(unid, name, content)`` as lines of a text file for each task, key and name, in folders below ``path`` that are named by column.

    Hadoop's local file system starts a process for each folder and file that it makes, where it lacks its native library, and the folders of a
    task are made twice over. So tasks make local files themselves; Spark writes those of any other file system.
    """
    spark = files.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri()
    if uri.getScheme() != "file":
        files.write.partitionBy("unid", "name").text(path)
        return
    local = uri.getPath()
    os.makedirs(local)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, file = f"part-{TaskContext.get().partitionId():05}.txt", None, None
        try:
            for batch in batches:
                for unid, name, content in zip(*(batch.column(i) for i in range(3)), strict=True):
                    key = unid.as_py(), name.as_py()
                    if key != last:
                        if file:
                            file.close()
                        folder = os.path.join(local, _folder("unid", key[0]), _folder("name", key[1]))
                        os.makedirs(folder, exist_ok=True)
                        last, file = key, open(os.path.join(folder, own), "wb")
                    file.write((content.as_py() or b"") + b"\n")
        finally:
            if file:
                file.close()
        yield from ()

    rows = files.select(*(F.nullif(c, F.lit("")).alias(c) for c in ("unid", "name")), F.col("content").cast("binary"))
    rows.sortWithinPartitions("unid", "name").mapInArrow(run, "done int").write.format("noop").mode("overwrite").save()


# The folders that this process has written, by application and tables.
_written: dict[tuple[str, str], str] = {}


def page_files(spark, sf_dir) -> str:
    """A folder of the pages' HTML sources, in files that end in a line break, one folder for each page and name; written once."""
    own = spark.sparkContext.applicationId, sf_dir
    if own not in _written:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="inkfold-")
        path = f"{folder.rstrip('/')}/page-files-{uuid.uuid4().hex}"
        files = page_attachments(spark, sf_dir).select("unid", F.nullif("name", F.lit("")).alias("name"), F.col("content").cast("string"))
        put_files(files.repartition(spark.sparkContext.defaultParallelism), path)
        _written[own] = path
    return _written[own]


def unid_keys(spark, sf_dir) -> DataFrame:
    """Customers of all orders as keys: most repeat, many name no note."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), unid("o_custkey"))


def note_id_keys(spark, sf_dir) -> DataFrame:
    """One part number per line item; those past the last part name no note."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"),
        (F.col("l_partkey") + F.col("l_suppkey")).cast("int").alias("note_id"),
    )


def entries(spark, sf_dir) -> DataFrame:
    """Events as entries of a view over the customers, some of which are gone."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"), F.lpad(F.hex(F.col("user_id") * 13), 32, "0").alias("unid")
    )
