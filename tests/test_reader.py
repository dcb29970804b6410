import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from inkfold import DEFAULT, EMPTY, BlankDocument, DocumentReader, attachment_source, load_documents
from inkfold.operators.attachments import list_attachments, named_attachment

TITLES = ["First title", "Second one", "A third, longer title with more words"]
CONTENTS = ["Some words about the first.", "Other words, with a comma.", "The last content; nothing follows."]

SYSTEM = (
    "2306 AS note_id, 'Memo' AS form, timestamp'2024-01-01' AS created, timestamp'2024-01-02' AS added_to_file, "
    "timestamp'2024-01-03' AS modified, timestamp'2024-01-04' AS modified_in_file, timestamp'2024-01-05' AS accessed, 100 AS size"
)


@pytest.fixture(scope="module")
def notes(spark):
    rows = [(f"U{i}", t, c) for i, (t, c) in enumerate(zip(TITLES, CONTENTS))]
    frame = spark.createDataFrame(rows, "unid STRING, title STRING, content STRING").coalesce(1)
    return frame.selectExpr("*", *SYSTEM.split(", "))


@pytest.fixture(scope="module")
def files(spark):
    rows = [("U0", i, f"memo-{i}.txt", c) for i, c in enumerate(CONTENTS)]
    rows += [("U0", 3, "plan.pdf", "%PDF rooms"), ("U0", 4, "NOTES.TXT", "loud words"), ("U0", 5, "noext", "x")]
    rows += [("U1", 0, "blank.txt", " \n"), ("U1", 1, "one.txt", "one"), ("gone", 0, "gone.txt", "gone")]
    return spark.createDataFrame(rows, "unid STRING, att_pos INT, name STRING, content STRING").withColumn(
        "content", F.col("content").cast("binary")
    )


def reader(definition=DEFAULT):
    return DocumentReader(definition)


@pytest.mark.parametrize(
    "wrong",
    [
        lambda n: reader().fields("title", "content"),
        lambda n: reader().notes(n),
        lambda n: reader().fields("title", "content").attachments().notes(n),
        lambda n: reader().attachments().table(n),
        lambda n: reader().attachments().on(n.sparkSession),
        lambda n: reader().attachments().on(n.sparkSession).location("nowhere.parquet", "/nowhere"),
        lambda n: reader().fields("title").table(n).unids([]).note_ids([]),
        lambda n: reader().fields("title").unids(["U0"]),
        lambda n: reader().fields("title").pattern("*.txt").notes(n),
    ],
)
def test_bad_configurations(notes, wrong):
    made = wrong(notes)
    with pytest.raises(Exception) as raised:
        made.load()
    # A path that does not exist is Spark's own error.
    assert isinstance(raised.value, ValueError) or "PATH_NOT_FOUND" in str(raised.value)


def test_null_parser_and_definition_are_refused():
    with pytest.raises(ValueError):
        reader().parser(None)
    with pytest.raises(ValueError):
        DocumentReader(None)


def test_fields_of_one_and_many_notes(notes):
    one = load_documents(DEFAULT, notes.limit(1), "title", "content").collect()
    assert [r.text for r in one] == [TITLES[0] + "\n" + CONTENTS[0]]
    many = reader().notes(notes).fields("title").fields("content").load_ordered().collect()
    assert [r.text for r in many] == [f"{t}\n{c}" for t, c in zip(TITLES, CONTENTS)]
    assert many[0].meta_form == "Memo" and many[0].meta_created == "2024-01-01T00:00:00Z" and many[0].meta_size == 100


def test_order_of_notes_with_and_without_a_position(spark, notes):
    placed = notes.withColumn("pos", 10 - F.substring("unid", 2, 1).cast("int"))
    made = reader(EMPTY).notes(placed).notes(placed.limit(1)).fields("title").load_ordered()
    assert [(r.batch, r.pos, r.unid) for r in made.collect()] == [(0, 8, "U2"), (0, 9, "U1"), (0, 10, "U0"), (1, 10, "U0")]
    with pytest.raises(ValueError):
        reader(EMPTY).notes(spark.sql("SELECT 'x' AS title")).fields("title").load_ordered()


def test_columns(notes, files):
    fields = reader(EMPTY.with_string("t", "title")).notes(notes).fields("content").keep("note_id").load()
    assert fields.columns == ["batch", "unid", "note_id", "text", "meta_t"]
    attached = reader(EMPTY.with_string("t", "title")).table(notes).unids(["U0"]).attachments(files).load()
    assert attached.columns == ["batch", "pos", "unid", "att_pos", "attachment_name", "text", "meta_t"]
    assert reader(EMPTY).notes(notes).fields("title").load().columns == ["batch", "unid", "text"]


def test_blank_notes_are_dropped(spark):
    frame = spark.sql("SELECT * FROM VALUES ('a', '', ' '), ('b', NULL, '\\t'), ('c', 'x', NULL), ('d', '', '') AS t(unid, p, q)")
    assert [r.unid for r in reader(EMPTY).notes(frame).fields("p", "q").load().collect()] == ["c"]


def test_attachments_in_order_with_metadata_of_their_note(notes, files):
    found = reader(EMPTY.with_string("t", "title")).notes(notes).attachments(files).load_ordered().collect()
    got = sorted((r.unid, r.att_pos, r.attachment_name, r.text, r.meta_t) for r in found)
    assert got == [
        ("U0", 0, "memo-0.txt", CONTENTS[0], TITLES[0]),
        ("U0", 1, "memo-1.txt", CONTENTS[1], TITLES[0]),
        ("U0", 2, "memo-2.txt", CONTENTS[2], TITLES[0]),
        ("U0", 3, "plan.pdf", "%PDF rooms", TITLES[0]),
        ("U0", 4, "NOTES.TXT", "loud words", TITLES[0]),
        ("U1", 1, "one.txt", "one", TITLES[1]),
    ]


@pytest.mark.parametrize(("pattern", "count"), [("*.txt", 4), ("*.pdf", 1), ("*.csv", 0), ("*", 6), ("", 5)])
def test_file_pattern(notes, files, pattern, count):
    assert reader().notes(notes.where("unid = 'U0'")).attachments(files).pattern(pattern).load().count() == count


@pytest.mark.parametrize("limit", [10**9, 0])
def test_all_ways_to_attachments_agree(spark, limit):
    """Broadcast, salted shuffle and array column give the same, one note holding most attachments."""
    rows = [("U0" if i % 3 else f"U{i % 7}", i, f"f{i}.{'txt' if i % 2 else 'TXT'}", f"text {i}") for i in range(600)]
    long = spark.createDataFrame(rows, "unid STRING, att_pos INT, name STRING, content STRING").withColumn(
        "content", F.col("content").cast("binary")
    )
    notes = spark.createDataFrame([(f"U{i}", f"note {i}") for i in range(5)] + [("U0", "again")], "unid STRING, title STRING")
    definition = EMPTY.with_string("title")
    titles = notes.collect()
    expected = sorted((unid, pos, text, title) for unid, pos, _, text in rows for u, title in titles if u == unid)
    found = DocumentReader(definition, broadcast_bytes=limit).notes(notes).attachments(long).load()
    assert sorted((r.unid, r.att_pos, r.text, r.meta_title) for r in found.collect()) == expected
    held = long.groupBy("unid").agg(F.array_sort(F.collect_list(F.struct("att_pos", "name", "content"))).alias("a"))
    files = F.transform("a", lambda a: F.struct(a["name"].alias("name"), a["content"].alias("content")))
    arrays = notes.join(held, "unid").withColumn("attachments", files)
    nested = DocumentReader(definition).notes(arrays).attachments().load()
    assert sorted((r.unid, r.text, r.meta_title) for r in nested.collect()) == sorted((u, x, t) for u, _, x, t in expected)


def test_parser_is_pluggable_for_attachments_and_fields(notes, files):
    def pdf(data):
        if not data.startswith(b"%PDF"):
            raise BlankDocument
        return data[5:].decode()

    made = reader(EMPTY).notes(notes).attachments(files).pattern("*").parser(pdf).load()
    assert [(r.attachment_name, r.text) for r in made.collect()] == [("plan.pdf", "rooms")]
    lengths = reader(EMPTY).notes(notes).fields("title", "content").parser(lambda data: str(len(data))).load()
    assert [r.text for r in lengths.collect()] == [str(len(t) + 1 + len(c)) for t, c in zip(TITLES, CONTENTS)]
    blanks = reader(EMPTY).notes(notes).fields("title").parser(lambda data: None if b"First" in data else " \t").load()
    assert blanks.count() == 0


def test_parsers_get_the_bytes_as_they_are(spark):
    columns = "unid STRING, att_pos INT, name STRING, content BINARY"
    files = spark.createDataFrame([("U0", 0, "a.bin", b"\xff\x00\xfe")], columns)
    notes = spark.createDataFrame([("U0",)], "unid STRING")
    made = reader(EMPTY).notes(notes).attachments(files).parser(lambda data: data.hex()).load()
    assert made.first().text == "ff00fe"


@pytest.mark.parametrize("parser", [None, lambda data: data.decode()])
def test_blank_documents_are_counted(notes, files, parser):
    base = reader(EMPTY).notes(notes)
    for source, counts in ((base.attachments(files), (7, 6)), (base.fields("title"), (3, 3))):
        read, kept = Observation(), Observation()
        made = source.count_into(read, kept)
        (made.parser(parser) if parser else made).load().collect()
        assert (read.get["rows"], kept.get["rows"]) == counts


def test_errors_of_a_parser_fail_the_query(notes):
    def bad(data):
        raise RuntimeError("cannot read this")

    with pytest.raises(Exception, match="cannot read this"):
        reader(EMPTY).notes(notes).fields("title").parser(bad).load().collect()


def test_sources_go_by_precedence(spark, notes):
    entries = spark.createDataFrame([(0, "U2"), (1, "U2")], "pos BIGINT, unid STRING")
    made = reader(EMPTY).fields("title").table(notes).note_ids([2306]).unids(["U1", "U1", "none"])
    assert [r.unid for r in made.load_ordered().collect()] == ["U1", "U1"]
    made = made.entries(entries)
    assert [(r.pos, r.unid) for r in made.load_ordered().collect()] == [(0, "U2"), (1, "U2")]
    assert [r.unid for r in made.notes(notes.limit(1)).load().collect()] == ["U0"]
    assert reader(EMPTY).fields("title").table(notes).note_ids([2306, 1]).load().count() == 3


def test_entries_bring_their_table(spark, notes):
    entries = spark.createDataFrame([(5, "U2")], "pos BIGINT, unid STRING")
    assert reader(EMPTY).fields("title").entries(entries, of=notes).load().first().pos == 5
    with pytest.raises(ValueError):
        reader(EMPTY).fields("title").entries(entries).load()


def test_repeated_calls_append(spark, notes):
    made = reader(EMPTY).fields("title").table(notes).unids(["U2", "U0"]).unids(["U2"])
    assert [(r.batch, r.pos, r.unid) for r in made.load_ordered().collect()] == [(0, 0, "U2"), (0, 1, "U0"), (1, 0, "U2")]
    keys = spark.createDataFrame([(9, "U1")], "pos BIGINT, unid STRING")
    assert [(r.batch, r.pos) for r in made.unids(keys).load_ordered().collect()][-1] == (2, 9)


def test_readers_are_immutable(notes):
    base = reader(EMPTY).notes(notes)
    base.fields("title")
    with pytest.raises(ValueError):
        base.load()


def test_table_by_handle_goes_before_path(spark, notes, tmp_path):
    notes.where("unid = 'U1'").write.parquet(str(tmp_path / "one"))
    made = reader(EMPTY).fields("title").on(spark).unids(["U0", "U1"]).location("one", str(tmp_path))
    assert [r.unid for r in made.load().collect()] == ["U1"]
    assert made.table(notes).load().count() == 2
    notes.createOrReplaceTempView("reader_notes")
    assert made.table("reader_notes").load().count() == 2


def test_named_attachment(notes, files):
    notes = notes.select("unid", "title")
    one = notes.where("unid = 'U0'")
    for limit in (10**9, 0):
        found = named_attachment(one, files, "plan.pdf", limit).collect()
        assert [bytes(r.content) for r in found] == [b"%PDF rooms"]
    for name in (None, ""):
        with pytest.raises(ValueError):
            named_attachment(one, files, name)
    with pytest.raises(ValueError, match="share"):
        named_attachment(one.withColumn("content", F.lit("x")), files, "plan.pdf")
    # Names are exact, and every note must have the attachment.
    for frame, name in ((one, "absent.pdf"), (one, "PLAN.PDF"), (notes, "plan.pdf")):
        with pytest.raises(Exception, match="attachment not found"):
            named_attachment(frame, files, name).collect()


def test_attachment_source(notes, files):
    found = attachment_source(notes.where("unid = 'U0'"), files, "NOTES.TXT").first()
    assert bytes(found.content) == b"loud words" and found.meta_unid == "U0"


def test_listing(notes, files):
    found = list_attachments(notes, files).collect()
    assert sorted(r.name for r in found) == sorted(
        ["memo-0.txt", "memo-1.txt", "memo-2.txt", "plan.pdf", "NOTES.TXT", "noext", "blank.txt", "one.txt"]
    )


@pytest.fixture(scope="module")
def odd_notes(spark):
    """Notes with items named as the reader's own columns, and keys in upper case."""
    rows = [(f"U{i}", f"B-{i}", f"left {i}", i) for i in range(5)]
    return spark.createDataFrame(rows, "UNID STRING, Batch STRING, pos STRING, note_id INT")


@pytest.mark.parametrize("limit", [10**9, 0])
def test_items_may_have_any_name(spark, odd_notes, limit):
    definition = EMPTY.with_string("batch").with_string("place", "upper(POS)")
    made = DocumentReader(definition, broadcast_bytes=limit).fields("batch", "Pos")
    text = lambda i: (f"B-{i}\nleft {i}", f"B-{i}", f"LEFT {i}")
    entries = spark.createDataFrame([(7, "U2"), (9, "U1")], "pos BIGINT, unid STRING")
    ways = {
        "entries": (made.table(odd_notes).entries(entries), [(0, 7, "U2", *text(2)), (0, 9, "U1", *text(1))]),
        "unids": (made.table(odd_notes).unids(["U3"]).unids(["U3", "U0"]), [(0, 0, "U3", *text(3)), (1, 0, "U3", *text(3)), (1, 1, "U0", *text(0))]),
        "note_ids": (made.table(odd_notes).note_ids([4, 4]), [(0, 0, "U4", *text(4)), (0, 1, "U4", *text(4))]),
    }
    for way, (given, want) in ways.items():
        found = given.load_ordered()
        assert found.columns == ["batch", "pos", "unid", "text", "meta_batch", "meta_place"], way
        assert [tuple(r) for r in found.collect()] == want, way
    direct = made.notes(odd_notes).load()
    assert direct.columns == ["batch", "pos", "unid", "text", "meta_batch", "meta_place"]
    assert sorted(tuple(r) for r in direct.collect()) == [(0, f"left {i}", f"U{i}", *text(i)) for i in range(5)]


@pytest.mark.parametrize("limit", [10**9, 0])
def test_items_of_any_name_beside_attachments(spark, odd_notes, limit):
    files = spark.createDataFrame([("U1", 0, "a.txt", b"one"), ("U3", 2, "b.txt", b"three")], "Unid STRING, att_pos INT, Name STRING, content BINARY")
    made = DocumentReader(EMPTY.with_string("batch"), broadcast_bytes=limit).attachments(files)
    want = [(0, 0, "U3", 2, "b.txt", "three", "B-3"), (0, 1, "U1", 0, "a.txt", "one", "B-1")]
    for given in (made.table(odd_notes).unids(["U3", "U1"]), made.table(odd_notes).note_ids([3, 1])):
        assert [tuple(r) for r in given.load_ordered().collect()] == want
    direct = made.notes(odd_notes).load()
    assert sorted(r.text for r in direct.collect()) == ["one", "three"] and direct.columns[:3] == ["batch", "pos", "unid"]


def test_kept_columns_that_clash_are_refused(odd_notes):
    made = reader(EMPTY.with_string("x", "'y'")).fields("pos").table(odd_notes).unids(["U1"])
    assert made.keep("note_id", "unid").load().columns == ["batch", "pos", "unid", "note_id", "text", "meta_x"]
    for name in ("Batch", "pos", "text", "META_X"):
        with pytest.raises(ValueError, match="columns to keep"):
            made.keep(name).load()


def jobs_started(spark, build):
    """Spark jobs that building a plan runs."""
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_every_input_is_profiled_once_at_most(spark, tmp_path):
    notes = spark.range(500).select(F.concat(F.lit("U"), "id").alias("unid"), F.col("id").cast("string").alias("title"), F.repeat(F.lit("x"), 1000).alias("body"))
    notes.write.parquet(str(tmp_path / "notes"))
    entries = spark.range(400).select(F.col("id").alias("pos"), F.concat(F.lit("U"), F.col("id") % 300).alias("unid"))
    entries.write.parquet(str(tmp_path / "entries"))
    files = spark.range(900).select(F.concat(F.lit("U"), F.col("id") % 350).alias("unid"), F.col("id").cast("int").alias("att_pos"), F.lit("a.txt").alias("name"), F.lit(b"text").alias("content"))
    files.write.parquet(str(tmp_path / "files"))
    read = {n: spark.read.parquet(str(tmp_path / n)) for n in ("notes", "entries", "files")}
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for limit, most in ((10**9, 2), (0, 3)):
            made = DocumentReader(EMPTY.with_string("title"), broadcast_bytes=limit).table(read["notes"]).entries(read["entries"])
            assert jobs_started(spark, lambda: made.attachments(read["files"]).load()) <= most  # noqa: B023
            assert jobs_started(spark, lambda: made.fields("title").load()) <= most  # noqa: B023
        listed = DocumentReader(EMPTY).table(read["notes"]).unids(["U1", "U2"]).fields("title")
        assert jobs_started(spark, listed.load) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_a_repeated_name_gives_the_first_file(spark):
    files = spark.createDataFrame([("U0", 3, "a.txt", b"late"), ("U0", 1, "a.txt", b"first"), ("U1", 0, "a.txt", b"other")], "unid STRING, att_pos INT, name STRING, content BINARY")
    # One note named very often: past the limit its rows are spread over the tasks.
    unid = F.when(F.col("id") % 3 > 0, "U0").otherwise("U1")
    notes = spark.range(600).select(unid.alias("unid"), F.col("id").alias("n"))
    for limit in (10**9, 0):
        found = named_attachment(notes, files, "a.txt", limit)
        assert found.columns == ["unid", "n", "att_pos", "name", "content"]
        assert sorted((r.n, bytes(r.content)) for r in found.collect()) == [(n, b"first" if n % 3 else b"other") for n in range(600)]


def test_extensions_prune_files_and_few_attachments_prune_notes(spark, tmp_path, plan_of):
    names = [("U%d" % i, i, f"f{i}.{'PDF' if i < 3 else 'txt'}", b"%d" % i, "pdf" if i < 3 else "txt") for i in range(40)]
    frame = spark.createDataFrame(names, "unid STRING, att_pos INT, name STRING, content BINARY, extension STRING")
    frame.write.partitionBy("extension").parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    notes = spark.range(40).select(F.concat(F.lit("U"), "id").alias("unid"), F.array("id").alias("tags"), F.repeat(F.lit("x"), 50).alias("title"))
    notes.write.parquet(str(tmp_path / "notes"))
    made = DocumentReader(EMPTY.with_string("title"), broadcast_bytes=0).notes(spark.read.parquet(str(tmp_path / "notes"))).attachments(files)
    picked = made.pattern("*.pdf").load()
    plan = plan_of(picked)
    assert "extension" in plan and "(extension#" in plan and "= pdf)" in plan
    assert "In(unid" in plan or "unid IN" in plan or "unid#" in plan
    assert sorted(r.text for r in picked.collect()) == ["0", "1", "2"]
    assert made.pattern("*.[pt]*").load().count() == 40
