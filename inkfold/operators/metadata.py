"""Metadata projection: a definition over a table of notes becomes a list of columns."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkfold.functions.values import typed_value
from inkfold.plans.definition import MetadataDefinition

PREFIX = "meta_"

# The system column that holds the size of a note.
SIZE = "size"

# A name alone, such as title or $revisions.
ITEM_NAME = re.compile(r"(?!\d)[\w$]+")

# Names of the zone in which a time reads the same as in UTC.
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


# What Spark reads as a value or function where no column has the name.
BARE_FUNCTIONS = frozenset(
    "current_catalog current_database current_date current_schema current_time current_timestamp current_user false localtime "
    "localtimestamp null session_user true user".split()
)

_LENIENT = threading.Lock()


@contextmanager
def lenient(spark: SparkSession) -> Iterator[None]:
    """Expressions that are resolved meanwhile give NULL on a row where they fail. The session's setting comes back after."""
    with _LENIENT:
        before = {name: spark.conf.get(name) for name in ("spark.sql.ansi.enabled", "spark.sql.legacy.sizeOfNull")}
        if before["spark.sql.ansi.enabled"] == "true":
            # The size of NULL stays NULL, as it is in a strict session.
            spark.conf.set("spark.sql.legacy.sizeOfNull", "false")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        try:
            yield
        finally:
            for name, value in before.items():
                spark.conf.set(name, value)


def with_metadata(
    notes: DataFrame, definition: MetadataDefinition, missing_text: str | None = None, failures: Observation | None = None
) -> tuple[DataFrame, list[Column]]:
    """The notes with the values of the definition's expressions, and from them one ``meta_<name>`` column per field.

    NULL stands for an absent key. A field that just names a column no note has is missing everywhere, unless the
    name is a function that needs no parentheses. An expression that fails on a row leaves the key out there: a cast, a
    division by zero, an index out of range. Whole-number overflow wraps, and ``raise_error`` still ends the query.
    ``missing_text`` replaces NULL in string fields that just name a column.

    ``failures`` counts, in the pass that computes the values, for each field that is an expression the rows on which it gives no value though
    every column it names has one, under the field's name. A column without a value is missing, not failed. An expression that gives
    NULL on purpose, as CASE without ELSE does, counts as well.
    """
    present = {name.lower() for name in notes.columns}

    def is_item(expr: str) -> bool:
        if expr.lower() in present:
            return True
        return ITEM_NAME.fullmatch(expr) is not None and expr.lower() not in BARE_FUNCTIONS

    values, computed, failed = [], [], []
    for number, field in enumerate(definition):
        if not is_item(field.expr):
            computed.append(F.expr(field.expr).alias(f"__meta_{number}"))
            values.append(F.col(f"__meta_{number}"))
            inputs = [F.col(f"`{c}`").isNotNull() for c in notes.columns if _names(field.expr, c)]
            without = reduce(Column.__and__, inputs, F.col(f"__meta_{number}").isNull())
            failed.append(F.count_if(without).alias(field.name))
        else:
            values.append(F.col(f"`{field.expr}`") if field.expr.lower() in present else F.lit(None))
    if computed:
        with lenient(notes.sparkSession):
            notes = notes.select("*", *computed)
    if failures is not None:
        # An observation needs a metric, also where no field can fail.
        notes = notes.observe(failures, *(failed or [F.lit(0).alias("none")]))
    # Resolving the values tells their types; nothing runs.
    types = [field.dataType for field in notes.select(*values).schema]
    utc = notes.sparkSession.conf.get("spark.sql.session.timeZone") in UTC_NAMES
    columns = []
    for field, value, dtype in zip(definition, values, types):
        column = typed_value(value, dtype, field.type, utc)
        if missing_text is not None and field.type == "string" and is_item(field.expr):
            column = F.coalesce(column, F.lit(missing_text))
        columns.append(column.alias(PREFIX + field.name))
    return notes, columns


_WORD = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`([^`]*)`|([^\W\d][\w$]*)")


def _names(expr: str, column: str) -> bool:
    """Whether an expression holds a name as that of the column, outside of string literals."""
    return any((quoted or plain).lower() == column.lower() for quoted, plain in _WORD.findall(expr))


def unsized(notes: DataFrame, definition: MetadataDefinition) -> tuple[str, ...]:
    """The metadata columns of fields that read ``size``, where the notes have no such column: the bytes of the text stand for it."""
    if any(c.lower() == SIZE for c in notes.columns):
        return ()
    return tuple(PREFIX + field.name for field in definition if field.expr.lower() == SIZE and field.type in ("integer", "long", "double"))


def needed_columns(notes: DataFrame, definition: MetadataDefinition, names: Iterable[str]) -> DataFrame:
    """The notes without columns that neither ``names`` nor any expression of the definition can mean."""
    wanted, expressions = {n.lower() for n in names}, [field.expr.lower() for field in definition]
    kept = [c for c in notes.columns if c.lower() in wanted or any(c.lower() in expr for expr in expressions)]
    return notes.select(*[F.col(f"`{c}`") for c in kept])
