import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from inkfold import DEFAULT, EMPTY
from inkfold.functions.names import right_back_sql
from inkfold.functions.values import is_empty_array, is_empty_string
from inkfold.operators.metadata import with_metadata

UTC = dt.timezone.utc


def metadata(frame, definition, **options):
    rows, columns = with_metadata(frame, definition, **options)
    return rows.select(*columns)


@pytest.fixture(scope="module")
def numbers(spark):
    rows = [
        (1, 5_000_000_000, 1e12, "5"),
        (2, 2_147_483_648, -1e12, ""),
        (3, -7, float("nan"), None),
        (4, None, 2.9, " "),
        (5, 0, -2.9, "x"),
        (6, 2**63 - 1, 1e300, "1.5"),
        (7, -(2**63), None, "5"),
    ]
    return spark.createDataFrame(rows, "id INT, l BIGINT, d DOUBLE, s STRING")


def java_int(value):
    if isinstance(value, float):
        return 0 if math.isnan(value) else int(max(min(value, 2**31 - 1), -(2**31)))
    return (value + 2**31) % 2**32 - 2**31


def java_long(value):
    if isinstance(value, float):
        return 0 if math.isnan(value) else int(max(min(math.trunc(value), 2**63 - 1), -(2**63)))
    return value


def test_integers_wrap_from_whole_numbers_and_saturate_from_fractions(numbers):
    found = metadata(numbers, EMPTY.with_integer("l").with_integer("d").with_integer("s").with_integer("id")).collect()
    for row, given in zip(found, numbers.collect()):
        assert row.meta_l == (None if given.l is None else java_int(given.l))
        assert row.meta_d == (None if given.d is None else java_int(given.d))
        assert row.meta_s is None and row.meta_id == given.id


def test_longs_saturate_from_fractions(numbers):
    found = metadata(numbers, EMPTY.with_long("l").with_long("d").with_long("s").with_long("id")).collect()
    for row, given in zip(found, numbers.collect()):
        assert row.meta_l == given.l
        assert row.meta_d == (None if given.d is None else java_long(given.d))
        assert row.meta_s is None and row.meta_id == given.id


def test_doubles(numbers):
    found = metadata(numbers, EMPTY.with_double("l").with_double("d").with_double("s")).collect()
    for row, given in zip(found, numbers.collect()):
        assert row.meta_l == (None if given.l is None else float(given.l))
        assert row.meta_d == given.d or math.isnan(given.d)
        assert row.meta_s is None


def test_decimals_are_numbers(spark):
    frame = spark.createDataFrame(
        [(Decimal("-2.9"),), (Decimal("12345678901234567890123"),), (Decimal("9007199254740993"),), (None,)],
        "x DECIMAL(30,2)",
    )
    found = metadata(frame, EMPTY.with_integer("i", "x").with_long("l", "x").with_double("d", "x")).collect()
    assert [tuple(r) for r in found] == [
        (-2, -2, -2.9),
        (2**31 - 1, 2**63 - 1, 1.2345678901234568e22),
        (2**31 - 1, 9007199254740993, 9007199254740992.0),
        (None, None, None),
    ]


def test_strings_take_any_value(spark):
    frame = spark.sql("SELECT 1.0D a, 1.0E7D b, 7 c, '' d, true e, CAST(NULL AS STRING) f, 5000000000L g")
    row = metadata(frame, EMPTY.extend(DEFINITION_OF("abcdefg"))).first()
    assert tuple(row) == ("1.0", "1.0E7", "7", "", "true", None, "5000000000")


def DEFINITION_OF(names):
    definition = EMPTY
    for name in names:
        definition = definition.with_string(name)
    return definition


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_temporal_is_utc_text_in_every_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.sql(
            "SELECT timestamp'2024-03-10 07:30:00.75Z' a, timestamp_ntz'2024-03-10 02:30:00' b, date'2024-02-29' c, "
            "'2024-01-01' d, 7 e, timestamp_micros(-1) f, CAST(NULL AS TIMESTAMP) g"
        )
        definition = EMPTY
        for name in "abcdefg":
            definition = definition.with_temporal(name)
        row = metadata(frame, definition).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (
        "2024-03-10T07:30:00Z",
        "2024-03-10T02:30:00Z",
        "2024-02-29",
        None,
        None,
        "1969-12-31T23:59:59Z",
        None,
    )


def test_first_of_several_values(spark):
    rows = [(1, None, None), (2, [], []), (3, ["a"], [3]), (4, ["a", "b"], [5_000_000_000, 1]), (5, ["", "b"], [None, 1])]
    frame = spark.createDataFrame(rows, "id INT, vals ARRAY<STRING>, nums ARRAY<BIGINT>")
    found = metadata(frame, EMPTY.with_string("vals").with_integer("nums").with_long("text", "vals")).collect()
    assert [tuple(r) for r in found] == [
        (None, None, None),
        (None, None, None),
        ("a", 3, None),
        ("a", 705032704, None),
        ("", None, None),
    ]


def test_missing_item_is_absent_or_the_given_text(spark):
    frame = spark.sql("SELECT 'x' AS Form, CAST(NULL AS STRING) AS note")
    definition = EMPTY.with_string("form").with_string("nowhere").with_string("note").with_long("n", "nowhere")
    assert tuple(metadata(frame, definition).first()) == ("x", None, None, None)
    assert tuple(metadata(frame, definition, missing_text="").first()) == ("x", "", "", None)


def test_items_with_unusual_names(spark):
    frame = spark.sql("SELECT 'a' AS `$Title`, 'b' AS `two words`, 3 AS `4th`")
    definition = EMPTY.with_string("$title").with_string("two words").with_integer("4th").with_string("$none").with_long("7")
    assert tuple(metadata(frame, definition).first()) == ("a", "b", 3, None, 7)


def test_failing_expressions_leave_the_document_alone(spark):
    frame = spark.sql("SELECT * FROM VALUES ('7', 0), ('x', 2) AS t(s, n)")
    definition = EMPTY.with_integer("number", "try_cast(s AS INT)").with_double("share", "try_divide(1, n)")
    assert [tuple(r) for r in metadata(frame, definition).collect()] == [(7, None), (None, 0.5)]


def test_unknown_columns_in_expressions_fail_at_once(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        with_metadata(spark.range(1), EMPTY.with_string("x", "upper(nowhere)"))


def test_default_definition(spark):
    at = dt.datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=UTC)
    rows = [("Memo", 2306, "0" * 31 + "A", at, at, at, at, at, 3_000_000_000), (None, -1, None, None, at, at, at, at, 17)]
    frame = spark.createDataFrame(
        rows,
        "Form STRING, note_id INT, unid STRING, created TIMESTAMP, added_to_file TIMESTAMP, modified TIMESTAMP, "
        "modified_in_file TIMESTAMP, accessed TIMESTAMP, size BIGINT",
    )
    text = "2024-05-06T07:08:09Z"
    first, second = metadata(frame, DEFAULT).collect()
    assert tuple(first) == ("Memo", "00000902", "0" * 31 + "A", text, text, text, text, text, -1294967296)
    assert int(first.meta_noteid, 16) == 2306
    assert tuple(second) == (None, "FFFFFFFF", None, None, text, text, text, text, 17)


def test_right_back(spark):
    frame = spark.sql("SELECT * FROM VALUES ('NT00000902'), ('aNTbNTc'), ('none'), ('NT'), (''), (NULL) AS t(x)")
    found = [r[0] for r in frame.select(F.expr(right_back_sql("x", "NT"))).collect()]
    assert found == ["00000902", "c", "", "", "", None]


def test_emptiness(spark):
    strings = spark.sql("SELECT * FROM VALUES (NULL), (''), (' '), ('a') AS t(s)")
    assert [r[0] for r in strings.select(is_empty_string(F.col("s"))).collect()] == [True, True, False, False]
    arrays = spark.createDataFrame([(None,), ([],), ([None],), (["a"],)], "a ARRAY<STRING>")
    assert [r[0] for r in arrays.select(is_empty_array(F.col("a"))).collect()] == [True, True, False, False]


def test_failing_expressions_leave_the_key_out(spark):
    """A cast, a division and an index that fail on a row are NULL there, in a session that is otherwise strict."""
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    frame = spark.sql("SELECT * FROM VALUES (1, 'x', array(1)), (0, '7', array(1, 2)) AS t(n, s, a)")
    definition = EMPTY.with_integer("number", "CAST(s AS INT)").with_double("share", "10 / n").with_integer("second", "a[1]")
    found = metadata(frame, definition).collect()
    assert [tuple(r) for r in found] == [(None, 10.0, None), (7, None, 2)]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame.selectExpr("CAST(s AS INT)").collect()


def test_names_that_are_functions(spark):
    frame = spark.sql("SELECT 1 AS n, 'mine' AS current_user")
    definition = EMPTY.with_temporal("at", "current_timestamp").with_string("yes", "true").with_string("who", "current_user").with_string("x", "nowhere")
    found = metadata(frame, definition).first()
    assert found.meta_at is not None and found.meta_yes == "true" and found.meta_who == "mine" and found.meta_x is None


def test_items_with_typed_values(spark):
    frame = spark.sql(
        "SELECT named_struct('kind', 'x', 'VALS', CAST(NULL AS ARRAY<STRING>), 'numbers', array(5.5D, 6D), 'times', CAST(NULL AS ARRAY<TIMESTAMP_NTZ>)) AS a, "
        "named_struct('kind', 'x', 'vals', CAST(NULL AS ARRAY<STRING>), 'numbers', CAST(NULL AS ARRAY<DOUBLE>), 'times', array(timestamp_ntz'2024-02-03 04:05:06')) AS t, "
        "named_struct('kind', 'x', 'vals', array('5'), 'numbers', CAST(NULL AS ARRAY<DOUBLE>), 'times', CAST(NULL AS ARRAY<TIMESTAMP_NTZ>)) AS s"
    )
    definition = EMPTY.with_integer("i", "a").with_double("d", "a").with_string("n", "a").with_temporal("t").with_integer("not_parsed", "s").with_string("s")
    assert tuple(metadata(frame, definition).first()) == (5, 5.5, "5.5", "2024-02-03T04:05:06Z", None, "5")
