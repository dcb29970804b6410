import random

import pytest
from pyspark.sql import functions as F

from inkfold import append, fetch, fetch_entries, lookup_note
from inkfold.operators.keyed import Profile, few_keys, fits, hot_salts, listed_profile, narrowed, profile, salted_join
from inkfold.sources.tables import key_frame, open_table


@pytest.fixture(scope="module")
def notes(spark):
    rows = [(f"U{n}", n, f"title {n}") for n in range(40)]
    return spark.createDataFrame(rows, "unid STRING, note_id INT, title STRING")


def test_ids_keep_position_and_repeats_and_drop_misses(notes):
    found = fetch(notes, [5, 999, 3, 5], "note_id").orderBy("pos").select("pos", "note_id", "title")
    assert [tuple(r) for r in found.collect()] == [(0, 5, "title 5"), (2, 3, "title 3"), (3, 5, "title 5")]
    found = fetch(notes, ["U7", "missing", "U7"]).orderBy("pos").select("pos", "unid")
    assert [tuple(r) for r in found.collect()] == [(0, "U7"), (2, "U7")]
    assert fetch(notes, ["missing"]).count() == 0


def brute(keys, size):
    return sorted((pos, key, int(key[1:])) for pos, key in keys if key and int(key[1:]) < size)


@pytest.mark.parametrize("limit", [10**9, 0])
def test_skewed_keys_give_the_same_rows_on_every_path(spark, notes, limit):
    rng = random.Random(3)
    # A third of the keys are the same one; some name no note, some are NULL.
    keys = [(pos, None if pos % 50 == 0 else "U7" if pos % 3 == 0 else f"U{rng.randint(0, 60)}") for pos in range(3000)]
    frame = spark.createDataFrame(keys, "pos BIGINT, unid STRING")
    # An array column keeps the notes from being measured and broadcast.
    wide = notes.withColumn("tags", F.array("title"))
    for table in (notes, wide):
        found = fetch(table, frame, limit=limit).select("pos", "unid", "note_id").collect()
        assert sorted(tuple(r) for r in found) == brute(keys, 40)


def test_hot_keys_are_spread_over_tasks(spark, notes):
    unid = F.when(F.col("id") % 3 == 0, "U7").otherwise(F.concat(F.lit("U"), F.col("id") % 40))
    keys = spark.range(9000).select(F.col("id").alias("pos"), unid.alias("unid"))
    salts = hot_salts(profile(keys, "unid"), 16)
    assert salts["U7"] >= 5 and all(n > 1 for n in salts.values())
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(keys, notes, "unid", salts)
        per_task = joined.where("unid = 'U7'").groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 9000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
    assert len(per_task) >= 3 and max(r["count"] for r in per_task) < 3075


def test_salted_integer_keys(spark, notes):
    keys = spark.range(1000).select(F.col("id").alias("pos"), F.lit(5).alias("note_id"))
    found = salted_join(keys, notes, "note_id", {5: 4})
    assert found.count() == 1000 and dict(found.dtypes)["note_id"] == "int"


def test_keys_hot_on_both_sides_meet_once(spark):
    def side(rows, hot, name):
        unid = F.when(F.col("id") < hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
        return spark.range(rows).select(unid.alias("unid"), F.col("id").alias(name))

    left, right = side(60, 40, "l"), side(50, 30, "r")
    plain = sorted(left.join(right, "unid").select("unid", "l", "r").collect())
    assert len(plain) == 40 * 30 + 10
    for salts in (({"hot": 5}, {"hot": 3}), ({"hot": 5}, {}), ({}, {"hot": 3}), ({"k45": 2}, {"hot": 3, "k41": 2}), ({}, {})):
        assert sorted(salted_join(left, right, "unid", *salts).select("unid", "l", "r").collect()) == plain


def test_profile_and_broadcast_check(spark, notes):
    found = profile(spark.sql("SELECT * FROM VALUES (1L, 'a'), (2L, 'a'), (3L, 'b') AS t(pos, unid)"), "unid")
    assert found.rows == 3 and dict(found.top) == {"a": 2, "b": 1}
    assert profile(notes.where("false"), "unid") == Profile(0, 0, 0) and hot_salts(Profile(0, 0, 0), 8) == {}
    assert profile(spark.range(7)) == Profile(7, 56, 8)
    nulls = spark.sql("SELECT CAST(NULL AS STRING) a, X'0102' b")
    assert profile(nulls) == Profile(1, 18, 18)
    whole = profile(notes)
    assert whole.rows == 40 and whole.size == sum(8 * 3 + len(f"U{n}") + len(f"title {n}") for n in range(40)) and whole.widest == 35
    assert fits(whole, 10**6) and not fits(whole, 100)
    assert not fits(profile(notes.withColumn("tags", F.array("title"))), 10**6)
    assert few_keys(profile(notes, "unid")) and few_keys(profile(spark.range(300), "id")) is None


def test_profiles_of_lists_and_bounds(spark, notes):
    listed = listed_profile(["U1", "U2", "U1", None])
    assert listed.rows == 3 and dict(listed.top) == {"U1": 2, "U2": 1} and listed.widest == 18
    bound = listed.times(profile(notes, "unid"))
    assert bound.rows == 3 and bound.size == 3 * (18 + 35) and bound.plus(bound).rows == 6


def test_every_hot_key_is_spread(spark):
    """400 keys of ten even shares each at 4,000 tasks: all of them are split, however many they are."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")
    try:
        keys = spark.range(400_000).select((F.col("id") % 400).alias("note_id"))
        salts = hot_salts(profile(keys, "note_id"), 4000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(salts) == 400 and set(salts.values()) == {10}


@pytest.mark.parametrize("rows", [10, 300])
def test_keys_of_any_type_at_any_size(spark, notes, rows):
    """An interval beside the key takes the same way for few and many keys."""
    unid = F.concat(F.lit("U"), F.col("id") % 45)
    keys = spark.range(rows).select(F.col("id").alias("pos"), unid.alias("unid"), F.expr("make_ym_interval(1, CAST(id AS INT))").alias("age"))
    assert fetch(notes, keys).count() == sum(n % 45 < 40 for n in range(rows))


def test_keys_named_like_items_are_refused(spark, notes):
    placed = notes.withColumnRenamed("title", "Pos")
    with pytest.raises(ValueError, match="share"):
        fetch(placed, ["U1"])
    entries = spark.sql("SELECT 4L AS pos, 'U2' AS unid")
    assert fetch_entries(placed, entries, pos="place").select("place", "Pos").collect() == [(4, "title 2")]
    with pytest.raises(ValueError, match="batch"):
        append([notes.withColumn("Batch", F.lit(1))])


def test_many_keys_read_few_row_groups(spark, tmp_path):
    """Forty keys of a sorted table in small row groups: the scan gives a small part of the rows."""
    path = str(tmp_path / "sorted")
    frame = spark.range(40_000).select(F.lpad("id", 8, "0").alias("unid"), F.col("id").alias("n"))
    frame.coalesce(1).write.option("parquet.block.size", "16384").option("parquet.block.row.count.limit", "1000").parquet(path)
    keys = [f"{n:08d}" for n in range(0, 4000, 100)]
    found = narrowed(spark.read.parquet(path), "unid", keys)
    assert found.count() == 40
    condition = found._jdf.queryExecution().optimizedPlan().toString()
    assert condition.count(" IN ") == 4


def test_entries(spark, notes):
    rows = [(3, "U1", "x"), (1, "U9", "y"), (2, "none", "z"), (7, "U1", "w")]
    entries = spark.createDataFrame(rows, "pos BIGINT, unid STRING, title STRING")
    found = fetch_entries(notes, entries).orderBy("pos").select("pos", "unid", "title").collect()
    assert [tuple(r) for r in found] == [(1, "U9", "title 9"), (3, "U1", "title 1"), (7, "U1", "title 1")]


def test_appending_keeps_repeats_and_missing_columns(spark, notes):
    small = notes.limit(0).select("unid").union(spark.sql("SELECT 'Z'"))
    found = append([notes.where("note_id < 2"), small, notes.where("note_id = 1")]).orderBy("batch", "unid")
    assert [(r.batch, r.unid, r.note_id) for r in found.collect()] == [(0, "U0", 0), (0, "U1", 1), (1, "Z", None), (2, "U1", 1)]
    with pytest.raises(ValueError):
        append([])


def test_single_note(spark, notes, tmp_path):
    assert lookup_note(table=notes, unid="U3").collect() == [("U3", 3, "title 3")]
    assert lookup_note(table=notes, note_id=4).first().unid == "U4"
    assert lookup_note(table=notes, unid="U3", note_id=4).first().unid == "U3"
    assert lookup_note(table=notes, note_id=0).first().unid == "U0"
    assert lookup_note(note=notes, table=None) is notes
    # A path replaces a table.
    notes.where("note_id = 9").write.parquet(str(tmp_path / "mail" / "nine"))
    other = dict(spark=spark, table=notes, path="mail/nine", base=str(tmp_path))
    assert lookup_note(**other, note_id=9).first().unid == "U9"
    with pytest.raises(ValueError):
        lookup_note(**other, note_id=3)


def test_single_note_in_one_scan(notes):
    """No job while the frame is built; the refusal is part of the plan, whichever columns are read."""
    assert lookup_note(table=notes, unid="U3", at_once=False).collect() == [("U3", 3, "title 3")]
    assert lookup_note(table=notes.union(notes), note_id=4, at_once=False).select("unid").collect() == [("U4",)]
    assert lookup_note(table=notes, unid="U3", at_once=False).columns == notes.columns
    for arguments, words in ((dict(unid="nope"), "no note with UNID nope"), (dict(note_id=99), "no note with note id 99")):
        refused = lookup_note(table=notes, **arguments, at_once=False)
        for read in (refused.collect, refused.select("title").collect, refused.count):
            with pytest.raises(Exception, match=words):
                read()
    with pytest.raises(ValueError):
        lookup_note(table=notes, at_once=False)


@pytest.mark.parametrize("arguments", [dict(), dict(unid="U3"), dict(unid=""), dict(unid="nope"), dict(note_id=99)])
def test_single_note_not_found(notes, arguments):
    with pytest.raises(ValueError):
        lookup_note(table=None if arguments == dict(unid="U3") else notes, **arguments)


def test_opening_tables(spark, notes, tmp_path):
    notes.write.parquet(str(tmp_path / "a.parquet"))
    notes.limit(3).write.json(str(tmp_path / "b"))
    assert open_table(spark, path="a.parquet", base=f"{tmp_path}/").count() == 40
    assert open_table(spark, path=str(tmp_path / "b"), format="json").count() == 3
    assert open_table(spark, table=notes, path="ignored") is notes
    notes.createOrReplaceTempView("some_notes")
    assert open_table(spark, "some_notes").count() == 40
    with pytest.raises(ValueError):
        open_table(spark)


def test_key_lists_are_local_relations(spark, plan_of):
    frame = key_frame(spark, [1, 2, 1], "note_id")
    assert frame.collect() == [(0, 1), (1, 2), (2, 1)] and "LocalTableScan" in plan_of(frame, "simple")
