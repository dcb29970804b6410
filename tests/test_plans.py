"""What the physical plans look like: scans pruned, filters pushed, nothing shuffled or computed twice."""

import re

import pytest
from pyspark.sql import functions as F

from inkfold import DEFAULT, EMPTY, DocumentReader, fetch, load_documents, lookup_note
from inkfold.functions.text import mime_text
from inkfold.operators.attachments import list_attachments, named_attachment
from inkfold.operators.documents import select_nonblank


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Notes and attachments as parquet tables sorted by UNID."""
    base = tmp_path_factory.mktemp("tables")
    ids = spark.range(2000).select(F.lpad(F.hex("id"), 32, "0").alias("unid"), F.col("id").cast("int").alias("note_id"))
    title, html = F.concat(F.lit("title "), "note_id").alias("title"), F.lit("<p>x</p>").alias("html")
    notes = ids.select("*", title, html, F.array("unid").alias("tags"))
    notes.repartitionByRange(4, "unid").write.parquet(f"{base}/notes")
    files = ids.select("unid", F.lit(0).alias("att_pos"), F.lit("a.txt").alias("name"), F.lit(b"text").alias("content"))
    files.write.parquet(f"{base}/files")
    return spark.read.parquet(f"{base}/notes"), spark.read.parquet(f"{base}/files")


def schema_read(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)", plan)


def test_fields_are_read_without_a_shuffle_and_only_those(tables, plan_of):
    plan = plan_of(load_documents(EMPTY.with_integer("note_id"), tables[0], "title"))
    assert "Exchange" not in plan and "Python" not in plan and "Sort" not in plan
    assert schema_read(plan) == ["unid:string,note_id:int,title:string"]


def test_text_is_computed_once(tables, plan_of):
    notes = tables[0]
    text = mime_text(F.lit(""), F.col("html"))
    plan = plan_of(select_nonblank(notes, [F.col("unid")], text), "simple")
    # One pass of the block tags; a filter pushed below the projection would hold a second one.
    assert plan.count("blockquote") <= 1
    assert plan.count("explode(filter") == 1


def test_named_references_are_folded_into_a_literal(tables, plan_of):
    plan = plan_of(tables[0].select(mime_text(F.lit(""), F.col("html"))), "simple")
    assert "from_json" not in plan and "Python" not in plan


def test_parsers_run_once_per_row(tables, plan_of):
    made = DocumentReader(EMPTY).notes(tables[0]).fields("title").parser(lambda data: data.decode()).load()
    assert plan_of(made, "simple").count("ArrowEvalPython") == 1


def test_few_keys_reach_the_scan(tables, plan_of):
    found = fetch(tables[0], ["0" * 31 + "1", "0" * 31 + "2"]).select("pos", "title")
    plan = plan_of(found)
    assert "In(unid" in plan and "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert "unid:string,title:string" in schema_read(plan)
    plan = plan_of(lookup_note(table=tables[0], note_id=7))
    assert "EqualTo(note_id,7)" in plan
    plan = plan_of(lookup_note(table=tables[0], note_id=7, at_once=False).select("title"))
    assert "EqualTo(note_id,7)" in plan and plan.count("+- Scan parquet") == 1 and "note_id:int,title:string" in schema_read(plan)
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_many_keys_are_broadcast_only_within_the_limit(spark, tables, plan_of):
    notes = tables[0]
    keys = notes.select(F.col("note_id").cast("bigint").alias("pos"), "unid")
    plan = plan_of(fetch(notes, keys))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(fetch(notes, keys, limit=1000))
        assert "BroadcastHashJoin" not in plan and "hashpartitioning(unid" in plan and "__left_part" not in plan
        hot = keys.withColumn("unid", F.when(F.col("pos") % 3 == 0, F.lit("0" * 31 + "1")).otherwise(F.col("unid")))
        assert "__left_part" in plan_of(fetch(notes, hot, limit=1000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_repeated_key_lists_share_one_scan(tables, plan_of):
    made = DocumentReader(EMPTY).table(tables[0]).fields("title").unids(["0" * 31 + "1"]).unids(["0" * 31 + "2"]).load()
    assert plan_of(made, "simple").count("FileScan") == 1


def test_contents_are_read_only_where_needed(tables, plan_of):
    notes, files = tables
    plan = plan_of(list_attachments(notes, files))
    assert not any("content" in columns for columns in schema_read(plan))
    plan = plan_of(DocumentReader(EMPTY.with_string("title")).notes(notes).attachments(files).load())
    assert "hashpartitioning" not in plan
    for limit in (10**9, 0):
        plan = plan_of(named_attachment(notes.select("unid"), files, "a.txt", limit))
        assert "EqualTo(name,a.txt)" in plan and "Sort" not in plan
        # The place of each file is found without its contents.
        assert any("content" not in columns and "att_pos" in columns for columns in schema_read(plan))


def test_few_notes_prune_the_attachments(tables, plan_of):
    notes, files = tables
    plan = plan_of(DocumentReader(EMPTY).notes(notes.where("note_id = 3")).attachments(files).load())
    assert "In(unid" in plan or "EqualTo(unid" in plan


def test_bucketed_tables_join_without_a_shuffle(spark, tables, plan_of):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("DROP TABLE IF EXISTS bucketed_notes")
    spark.sql("DROP TABLE IF EXISTS bucketed_files")
    try:
        for frame, name in zip(tables, ("bucketed_notes", "bucketed_files")):
            frame.write.bucketBy(8, "unid").sortBy("unid").saveAsTable(name)
        made = DocumentReader(EMPTY.with_string("title"), broadcast_bytes=0).notes(spark.table("bucketed_notes"))
        documents = made.attachments(spark.table("bucketed_files")).load()
        assert "Exchange" not in plan_of(documents) and documents.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE bucketed_notes")
        spark.sql("DROP TABLE bucketed_files")


def test_metadata_of_all_types_stays_in_generated_code(tables, plan_of):
    definition = EMPTY.with_string("title").with_long("note_id").with_temporal("at", "timestamp_seconds(note_id)")
    plan = plan_of(load_documents(definition, tables[0], "title"), "simple")
    assert "Python" not in plan and plan.count("*(") >= 2
    assert len(DEFAULT) == 9
