import pytest

from inkfold import EMPTY, DocumentReader, load_documents
from inkfold.streaming import stream_documents


def test_a_stream_gives_the_documents_of_a_batch(spark, tmp_path):
    source = str(tmp_path / "notes")
    rows = [(f"U{i}", "" if i % 4 == 0 else f"title {i}", i) for i in range(20)]
    frame = spark.createDataFrame(rows, "unid STRING, title STRING, n BIGINT")
    frame.write.parquet(source)
    definition = EMPTY.with_integer("n")
    stream = spark.readStream.schema(frame.schema).parquet(source)
    documents = stream_documents(stream, definition, ["title"])
    query = documents.writeStream.format("memory").queryName("streamed").trigger(availableNow=True).start()
    query.awaitTermination(60)
    expected = load_documents(definition, frame, "title").drop("batch").collect()
    assert sorted(spark.table("streamed").collect()) == sorted(expected) and len(expected) == 15


def test_a_reader_takes_a_stream_with_nested_attachments(spark, tmp_path):
    source = str(tmp_path / "notes")
    frame = spark.range(6).selectExpr(
        "concat('U', id) AS unid",
        "array(named_struct('name', 'a.txt', 'content', CAST(concat('text ', id) AS BINARY)), "
        "named_struct('name', 'b.pdf', 'content', X'00')) AS attachments",
    )
    frame.write.parquet(source)
    stream = spark.readStream.schema(frame.schema).parquet(source)
    documents = DocumentReader(EMPTY).notes(stream).attachments().pattern("*.TXT").load()
    query = documents.writeStream.format("memory").queryName("attached").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted(r.text for r in spark.table("attached").collect()) == [f"text {i}" for i in range(6)]


def test_a_batch_is_no_stream(spark):
    with pytest.raises(ValueError):
        stream_documents(spark.range(1), EMPTY, ["title"])
