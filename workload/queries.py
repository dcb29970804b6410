"""One query per operator, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkfold import (
    DEFAULT,
    EMPTY,
    DocumentReader,
    FileStore,
    MetadataDefinition,
    append,
    attachment_source,
    based_on,
    fetch,
    fetch_entries,
    field_source,
    lookup_note,
    wide_notes,
)
from inkfold.functions.html import html_text
from inkfold.functions.names import matches_glob
from inkfold.functions.text import (
    decode_utf8,
    fields_text,
    mime_text,
    multivalue_text,
    not_blank,
    richtext_text,
    tagged_item_text,
)
from inkfold.functions.values import is_empty_array, is_empty_string
from inkfold.operators.attachments import list_attachments, matching, named_attachment, unnest_attachments
from inkfold.operators.documents import select_nonblank
from inkfold.operators.metadata import with_metadata
from inkfold.sources.tables import open_table as open_notes
from workload.notes import (
    addresses,
    customer_notes,
    default_notes,
    document_notes,
    entries,
    item_notes,
    long_items,
    note_id_keys,
    order_notes,
    page_attachments,
    page_file,
    page_files,
    page_notes,
    part_notes,
    table,
    turn_attachments,
    unid,
    unid_keys,
)

DOCUMENT_METADATA = EMPTY.with_string("source").with_string("lang").with_integer("size", "n_chars")


def projected(notes, definition: MetadataDefinition, *keep):
    rows, metadata = with_metadata(notes, definition)
    return rows.select(*keep, *metadata)


# Whole loads


def load_fields(spark, d):
    notes = document_notes(spark, d)
    return DocumentReader(DOCUMENT_METADATA).notes(notes).fields("source", "subject", "lang", "body").load().drop("batch")


def load_sparse_fields(spark, d):
    """Most notes have no contacts, so their documents are blank and dropped."""
    notes = document_notes(spark, d)
    return DocumentReader(DOCUMENT_METADATA).notes(notes).fields("contacts").load().drop("batch")


def load_by_unid(spark, d):
    reader = DocumentReader(EMPTY.with_double("balance", "c_acctbal")).table(customer_notes(spark, d))
    return reader.unids(unid_keys(spark, d)).fields("c_name", "c_mktsegment").load().drop("batch")


def load_attachments(spark, d):
    notes, files = document_notes(spark, d), turn_attachments(spark, d)
    return DocumentReader(DOCUMENT_METADATA).notes(notes).attachments(files).load().drop("batch")


def load_attachment_pattern(spark, d):
    notes, files = document_notes(spark, d), turn_attachments(spark, d)
    reader = DocumentReader(DOCUMENT_METADATA).notes(notes).attachments(files)
    return reader.pattern("turn[0-3].{USER,system}.*").load().drop("batch")


def load_entry_attachments(spark, d):
    notes, files = customer_notes(spark, d), turn_attachments(spark, d)
    reader = DocumentReader(EMPTY.with_string("owner", "c_name")).table(notes)
    return reader.entries(entries(spark, d)).attachments(files).load().drop("batch")


def load_nested_attachments(spark, d):
    """Attachments in an array column of their note."""
    pages = table(spark, d, "pages")
    file = F.struct(page_file(F.col("url")).alias("name"), F.col("html").cast("binary").alias("content"))
    link = F.struct(F.lit("link.url").alias("name"), F.col("url").cast("binary").alias("content"))
    notes = pages.select(unid("page_id"), "url", F.array(file, link).alias("attachments"))
    return DocumentReader(EMPTY.with_string("url")).notes(notes).attachments().load().drop("batch")


def load_long_items(spark, d):
    """Notes whose items are rows of a table of their own, beside a table of their system values."""
    notes = wide_notes(long_items(spark, d), ["source", "lang", "body", "page", "size_k", "seen"], notes=item_notes(spark, d))
    definition = (
        EMPTY.with_string("lang")
        .with_integer("whole", "size_k")
        .with_double("size_k")
        .with_temporal("seen")
        .with_integer("not_a_number", "source")
        .with_string("noteid", "CAST(note_id AS STRING)")
    )
    reader = DocumentReader(definition).notes(notes)
    return reader.fields("Source", "Page", "Body", "size_k").load().drop("batch")


def load_itemless_notes(spark, d):
    """Attachments of notes beside the default metadata of the table of notes. Most notes have no page, and many none of the items."""
    notes = wide_notes(long_items(spark, d), ["source", "page"], notes=default_notes(spark, d))
    definition = DEFAULT.with_string("source").with_string("page", "page.plain")
    return DocumentReader(definition).notes(notes).attachments(turn_attachments(spark, d)).load().drop("batch")


def load_reserved_names(spark, d):
    """Notes with items named as the reader's own columns, fetched by keys of another case from two lists."""
    notes = document_notes(spark, d).select(F.col("unid").alias("UNID"), F.col("lang").alias("batch"), F.col("source").alias("Pos"), "body")
    definition = EMPTY.with_string("batch").with_string("place", "upper(pos)")
    reader = DocumentReader(definition).table(notes).unids(unid_keys(spark, d)).unids(entries(spark, d))
    return reader.fields("batch", "pos", "body").load()


def load_attachment_extension(spark, d):
    """Text files of a table that names their extension in a column."""
    files = turn_attachments(spark, d)
    ending = F.when(F.contains("name", F.lit(".")), F.lower(F.substring_index("name", ".", -1)))
    return DocumentReader(EMPTY.with_string("lang")).notes(document_notes(spark, d)).attachments(files.withColumn("extension", ending)).pattern("TURN*.TxT").load().drop("batch")


def load_file_attachments(spark, d):
    """Attachments that are files, of which only those with matching names are opened."""
    pages = table(spark, d, "pages").select(unid("page_id"), "url")
    store = FileStore(page_files(spark, d), layout=None, least_bytes=1)
    return DocumentReader(EMPTY.with_string("url")).notes(pages).attachments(store).pattern("*.[h]tm{,l}").load().drop("batch")


def list_file_attachments(spark, d):
    """Names and lengths of all files, none of which is opened."""
    found = FileStore(page_files(spark, d), layout=None).attachments(spark)
    return found.select("unid", "att_pos", "name", "length")


def parser_udf(spark, d):
    def shout(data: bytes) -> str:
        # Upper-cases ASCII letters and leaves all other bytes alone.
        return data.upper().decode("utf-8")

    notes = document_notes(spark, d)
    return DocumentReader(EMPTY.with_string("lang")).notes(notes).fields("body").parser(shout).load().drop("batch")


def parser_attachments(spark, d):
    def lines_back(data: bytes) -> str:
        return "\n".join(reversed(data.decode("utf-8").split("\n")))

    notes, files = document_notes(spark, d), turn_attachments(spark, d)
    return DocumentReader(EMPTY).notes(notes).attachments(files).parser(lines_back).load().drop("batch")


def text_of_notes(spark, d):
    """Text and metadata of every note, blank texts included."""
    return field_source(document_notes(spark, d), ["contacts"], EMPTY.with_string("unid").with_string("lang"))


def attachment_of_notes(spark, d):
    """The bytes of one attachment of every note beside the note's metadata."""
    notes = table(spark, d, "conversations").groupBy(unid("conv_id")).agg(F.count(F.lit(1)).alias("turns"))
    files = turn_attachments(spark, d).withColumn("name", F.format_string("turn%d.txt", "att_pos"))
    definition = EMPTY.with_string("unid").with_integer("turns")
    found = attachment_source(notes, files, "turn0.txt", definition)
    return found.withColumn("content", F.decode("content", "UTF-8"))


# Sources


def open_table(spark, d):
    return open_notes(spark, path="orders.parquet", base=d)


def fetch_by_unid(spark, d):
    found = fetch(document_notes(spark, d), unid_keys(spark, d))
    return found.select("pos", "unid", "source", "lang", "n_chars")


def fetch_by_noteid(spark, d):
    found = fetch(part_notes(spark, d), note_id_keys(spark, d), "note_id")
    return found.select("pos", "note_id", "p_name", "p_brand", "p_size")


def fetch_view_entries(spark, d):
    found = fetch_entries(customer_notes(spark, d), entries(spark, d))
    return found.select("pos", "unid", "c_name", "c_mktsegment")


def lookup(spark, d):
    return lookup_note(table=order_notes(spark, d), unid="0" * 29 + "4D2", note_id=7, at_once=False).select("unid", "note_id", "form", "size")


def append_sources(spark, d):
    documents = document_notes(spark, d).select("unid", "source", "lang")
    customers = customer_notes(spark, d).select("unid", F.col("c_mktsegment").alias("source"))
    return append([documents, customers, documents])


def list_all_attachments(spark, d):
    return list_attachments(document_notes(spark, d), turn_attachments(spark, d))


def list_nested_attachments(spark, d):
    """The lines of each document as its attachments, named by their places and lengths."""
    notes = document_notes(spark, d)
    files = F.transform(
        "lines",
        lambda line, i: F.struct(
            F.concat(i.cast("string"), F.lit("-"), F.length(line), F.lit(".txt")).alias("name"), line.cast("binary").alias("content")
        ),
    )
    return unnest_attachments(notes.select("unid", files.alias("attachments"))).select("unid", "att_pos", "name")


def named(spark, d):
    """The second turn of every conversation, all turns being attachments numbered from 0."""
    notes = table(spark, d, "conversations").select(unid("conv_id")).distinct()
    files = turn_attachments(spark, d).withColumn("name", F.format_string("turn%d.txt", "att_pos"))
    found = named_attachment(notes, files, "turn1.txt")
    return found.select("unid", "name", F.decode("content", "UTF-8").alias("content"))


# Metadata


def metadata_default(spark, d):
    return projected(order_notes(spark, d), DEFAULT)


def metadata_empty(spark, d):
    return DocumentReader(EMPTY).notes(document_notes(spark, d)).fields("body").load().drop("batch")


LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def metadata_string(spark, d):
    definition = (
        EMPTY.with_string("l_returnflag")
        .with_string("quantity", "l_quantity")
        .with_string("line", "l_linenumber")
        .with_string("discount", "l_discount")
        .with_string("absent", "CASE WHEN l_discount > 0.05 THEN '' END")
    )
    return projected(table(spark, d, "lineitem"), definition, *LINE)


# NaN and values outside every range come from the line's own numbers.
WIDE_NUMBER = "CASE WHEN l_discount = 0 THEN double('NaN') ELSE (l_tax - 0.04) * 1e{} END"


def metadata_integer(spark, d):
    definition = (
        EMPTY.with_integer("l_linenumber")
        .with_integer("price", "-l_extendedprice")
        .with_integer("saturated", WIDE_NUMBER.format(12))
        .with_integer("wrapped", "l_orderkey * 3000017 - l_partkey * 5000011")
        .with_integer("text", "l_returnflag")
    )
    return projected(table(spark, d, "lineitem"), definition, *LINE)


def metadata_long(spark, d):
    definition = (
        EMPTY.with_long("l_linenumber")
        .with_long("l_orderkey")
        .with_long("price", "-l_extendedprice")
        .with_long("saturated", WIDE_NUMBER.format(21))
        .with_long("text", "l_returnflag")
    )
    return projected(table(spark, d, "lineitem"), definition, *LINE)


def metadata_double(spark, d):
    definition = (
        EMPTY.with_double("l_quantity")
        .with_double("l_orderkey")
        .with_double("net", "l_extendedprice * (1 - l_discount)")
        .with_double("text", "l_returnflag")
    )
    return projected(table(spark, d, "lineitem"), definition, *LINE)


def metadata_temporal(spark, d):
    definition = (
        EMPTY.with_temporal("at", "ts")
        .with_temporal("day", "CAST(ts AS DATE)")
        .with_temporal("kind", "event_type")
        .with_temporal("number", "value")
    )
    return projected(table(spark, d, "events"), definition, "event_id")


def metadata_custom(spark, d):
    definition = (
        EMPTY.with_string("priority", "lower(substring_index(o_orderpriority, '-', -1))")
        .with_string("label", "concat_ws('/', o_orderstatus, o_orderpriority)")
        .with_integer("year", "year(o_orderdate)")
        .with_long("cents", "round(o_totalprice * 100)")
        .with_double("thousands", "o_totalprice / 1000")
        .with_temporal("due", "o_orderdate + INTERVAL '30' DAY")
    )
    return projected(table(spark, d, "orders"), definition, "o_orderkey")


def metadata_override(spark, d):
    base = EMPTY.with_string("name", "p_name").with_string("size", "p_size").with_double("price", "p_retailprice")
    derived = based_on(base).with_string("brand", "p_brand").with_integer("size", "p_size * 2")
    return projected(part_notes(spark, d), derived, "unid")


def metadata_first_value(spark, d):
    definition = EMPTY.with_string("contact", "contacts").with_string("title", "lines")
    return projected(document_notes(spark, d), definition, "unid")


def metadata_skip_missing(spark, d):
    """Labels cover some notes only, and an expression that fails leaves the key out."""
    notes = document_notes(spark, d).join(table(spark, d, "labels"), "doc_id", "left")
    definition = (
        EMPTY.with_integer("quality")
        .with_long("toxic")
        .with_string("author")
        .with_double("per_quality", "n_chars / quality")
        .with_integer("lang_number", "CAST(lang AS INT)")
    )
    return projected(notes, definition, "doc_id")


# Text


def item_fields_text(spark, d):
    notes = document_notes(spark, d)
    text = fields_text(notes, ["lang", "contacts", "nowhere", "source", "lang", "body"])
    return notes.select("unid", text.alias("text"))


def multivalue(spark, d):
    return document_notes(spark, d).select("unid", multivalue_text(F.col("lines")).alias("text"))


def line_runs(lines):
    """Lines as rich-text runs; those with a bar are tables."""
    kind = lambda line: F.when(F.contains(line, F.lit("|")), "table").otherwise("text")
    return F.transform(lines, lambda line: F.struct(kind(line).alias("kind"), line.alias("text")))


def richtext(spark, d):
    notes = document_notes(spark, d)
    return notes.select("unid", richtext_text(line_runs(F.col("lines"))).alias("text"))


def mime_body(spark, d):
    notes = page_notes(spark, d)
    return notes.select("page_id", mime_text(F.col("body.plain"), F.col("body.html")).alias("text"))


def html_pages(spark, d):
    return table(spark, d, "pages").select("page_id", html_text(F.col("html")).alias("text"))


def item_dispatch(spark, d):
    """Pages as MIME items, documents with bars as rich text, the others as multi-values."""
    documents = document_notes(spark, d).select(
        F.lit("document").alias("origin"),
        "unid",
        F.struct(
            F.when(F.contains("body", F.lit("|")), "richtext").otherwise("values").alias("kind"),
            F.col("lines").alias("vals"),
            line_runs(F.col("lines")).alias("runs"),
            F.lit(None).cast("string").alias("plain"),
            F.lit(None).cast("string").alias("html"),
        ).alias("item"),
    )
    pages = page_notes(spark, d).select(
        F.lit("page").alias("origin"),
        "unid",
        F.struct(
            F.lit("mime").alias("kind"),
            F.lit(None).cast("array<string>").alias("vals"),
            F.lit(None).cast("array<struct<kind:string,text:string>>").alias("runs"),
            F.col("body.plain").alias("plain"),
            F.col("body.html").alias("html"),
        ).alias("item"),
    )
    items = documents.unionByName(pages)
    return items.select("origin", "unid", tagged_item_text(F.col("item")).alias("text"))


def decode_text(spark, d):
    """Document bytes ending in one that is no UTF-8."""
    broken = F.concat(F.col("text").cast("binary"), F.lit(bytearray(b"\xff")))
    return table(spark, d, "documents").select("doc_id", decode_utf8(broken).alias("text"))


# Filters


def glob_filter(spark, d):
    return matching(page_attachments(spark, d), "[!5-9]*.HTM{,l}").select("unid", "name")


def glob_default(spark, d):
    return matching(page_attachments(spark, d)).select("unid", "name")


def glob_match(spark, d):
    """Globs across and within path segments, over whole URLs."""
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id",
        matches_glob(url, "HTTPS:**/??/*").alias("secure_language"),
        matches_glob(url, "*example*").alias("one_segment"),
        matches_glob(url, "**.{com,net}/**[?]*").alias("with_query"),
    )


def blank_filter(spark, d):
    """The addresses of each document among blanks, for most of them the blanks alone."""
    documents = table(spark, d, "documents")
    found = F.array_join(addresses("text"), " ")
    return select_nonblank(documents, [F.col("doc_id")], F.concat(F.lit("\t\x1f "), found, F.lit("\n")))


def is_empty_text(spark, d):
    found = F.col("found")
    return table(spark, d, "documents").withColumn("found", F.array_join(addresses("text"), " ")).select(
        "doc_id",
        is_empty_string(found).alias("no_address"),
        is_empty_string(F.when(found != "", found)).alias("null_address"),
        is_empty_string(F.lit(" ")).alias("space"),
        (~is_empty_string(F.col("text"))).alias("has_text"),
        not_blank(F.col("text")).alias("has_visible_text"),
    )


def is_empty_values(spark, d):
    return document_notes(spark, d).select(
        "unid",
        is_empty_array(F.col("contacts")).alias("no_contacts"),
        is_empty_array(F.when(F.size("contacts") > 0, F.col("contacts"))).alias("null_contacts"),
        (~is_empty_array(F.col("lines"))).alias("has_lines"),
    )


QUERIES = {
    "load_fields": load_fields,
    "load_sparse_fields": load_sparse_fields,
    "load_by_unid": load_by_unid,
    "load_attachments": load_attachments,
    "load_attachment_pattern": load_attachment_pattern,
    "load_entry_attachments": load_entry_attachments,
    "load_nested_attachments": load_nested_attachments,
    "load_long_items": load_long_items,
    "load_itemless_notes": load_itemless_notes,
    "load_reserved_names": load_reserved_names,
    "load_attachment_extension": load_attachment_extension,
    "load_file_attachments": load_file_attachments,
    "list_file_attachments": list_file_attachments,
    "parser_udf": parser_udf,
    "parser_attachments": parser_attachments,
    "field_source": text_of_notes,
    "attachment_source": attachment_of_notes,
    "open_table": open_table,
    "fetch_by_unid": fetch_by_unid,
    "fetch_by_noteid": fetch_by_noteid,
    "fetch_view_entries": fetch_view_entries,
    "lookup_note": lookup,
    "append_sources": append_sources,
    "list_attachments": list_all_attachments,
    "list_nested_attachments": list_nested_attachments,
    "named_attachment": named,
    "metadata_default": metadata_default,
    "metadata_empty": metadata_empty,
    "metadata_string": metadata_string,
    "metadata_integer": metadata_integer,
    "metadata_long": metadata_long,
    "metadata_double": metadata_double,
    "metadata_temporal": metadata_temporal,
    "metadata_custom": metadata_custom,
    "metadata_override": metadata_override,
    "metadata_first_value": metadata_first_value,
    "metadata_skip_missing": metadata_skip_missing,
    "fields_text": item_fields_text,
    "multivalue_text": multivalue,
    "richtext_text": richtext,
    "mime_body": mime_body,
    "html_text": html_pages,
    "item_dispatch": item_dispatch,
    "decode_text": decode_text,
    "glob_filter": glob_filter,
    "glob_default": glob_default,
    "glob_match": glob_match,
    "blank_filter": blank_filter,
    "is_empty_string": is_empty_text,
    "is_empty_array": is_empty_values,
}
