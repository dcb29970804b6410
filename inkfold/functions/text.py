"""Text of a note: items of every kind as strings, several fields joined, blanks recognised."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkfold.functions.html import html_text

# What trimming removes, the characters up to and including the space.
TRIMMED = "".join(map(chr, range(0x21)))

# The parts of an item that carries its kind.
ITEM_PARTS = ("kind", "vals", "numbers", "times", "runs", "plain", "html")
STRING_PARTS = ("kind", "vals", "runs", "plain", "html")


def not_blank(text: Column) -> Column:
    """Has a character other than control characters and spaces; NULL for NULL."""
    # Trimming stops at the first character kept; a regex would decode the whole text first.
    return F.ltrim(text, F.lit(TRIMMED)) != ""


def decode_utf8(content: Column) -> Column:
    """Bytes as UTF-8 text, malformed sequences as U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def multivalue_text(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), " ")


def richtext_text(runs: Column) -> Column:
    """The text runs of a rich-text item one after the other, other records left out."""
    kept = F.filter(runs, lambda run: run["kind"] == "text")
    return F.array_join(F.transform(kept, lambda run: run["text"]), "")


def mime_text(plain: Column, html: Column) -> Column:
    """The plain part if it has text, else the text of the HTML part, else ''."""
    return F.coalesce(F.nullif(plain, F.lit("")), html_text(html), F.lit(""))


def tagged_item_text(item: Column, parts: Iterable[str] = STRING_PARTS) -> Column:
    """Text of an item that says itself what it is in ``kind``; NULL for a missing item.

    ``parts`` are the fields the item has. A part it lacks is missing in all items.
    """
    part = {name: item[name] if name in parts else F.lit(None) for name in ITEM_PARTS}
    text = F.when(item.isNull(), F.lit(None).cast("string"))
    if "runs" in parts:
        text = text.when(part["kind"] == "richtext", richtext_text(part["runs"]))
    if "plain" in parts or "html" in parts:
        text = text.when(part["kind"] == "mime", mime_text(part["plain"], part["html"]))
    # Values of one type are set; those of the others are NULL or empty.
    values = [multivalue_text(part[name]) for name in ("vals", "numbers", "times") if name in parts]
    return text.otherwise(F.coalesce(*[F.nullif(value, F.lit("")) for value in values], F.lit("")))


def item_text(item: Column, dtype: T.DataType) -> Column:
    """Text of an item, read according to the shape of its column."""
    if isinstance(dtype, T.StructType):
        parts = {name.lower() for name in dtype.names}
        if {"kind", "vals"} <= parts:
            return tagged_item_text(item, parts)
        if {"plain", "html"} <= parts:
            return F.when(item.isNotNull(), mime_text(item["plain"], item["html"]))
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if isinstance(element, T.StructType) and {"kind", "text"} <= {n.lower() for n in element.names}:
            return richtext_text(item)
        return multivalue_text(item)
    if isinstance(dtype, T.BinaryType):
        return decode_utf8(item)
    return item.cast("string")


def _texts(items: list[Column], dtype: T.DataType) -> list[Column]:
    """The texts of items of one type, NULL for ''; as one array where that saves analysing a long expression for each."""

    def text(item: Column) -> Column:
        return F.nullif(item_text(item, dtype), F.lit(""))

    if len(items) > 1 and isinstance(dtype, T.StructType):
        return [F.transform(F.array(*items), text)]
    return [text(item) for item in items]


def fields_text(notes: DataFrame, fields: Iterable[str]) -> Column:
    """Text of the named fields of a note in the order given, each name once, joined by a line break; NULL and '' add neither
    text nor line break.

    A field no note has is a missing item and adds nothing. Names are found as Spark finds them,
    without regard to case.
    """
    columns = {field.name.lower(): field for field in notes.schema}
    known = [columns[name.lower()] for name in dict.fromkeys(fields) if name.lower() in columns]
    texts = []
    for dtype, group in groupby(known, key=lambda field: field.dataType):
        texts += _texts([notes[f"`{field.name}`"] for field in group], dtype)
    return F.concat_ws("\n", *texts)
