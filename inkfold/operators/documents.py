"""From picked notes to documents: text and metadata, blank documents dropped."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from inkfold.functions.names import DEFAULT_GLOB
from inkfold.functions.text import decode_utf8, fields_text, not_blank
from inkfold.operators.attachments import (
    ATT_POS,
    ATTACHMENT,
    CONTENT,
    NAME,
    join_attachments,
    matching,
    named_attachment,
    unnest_attachments,
)
from inkfold.operators.keyed import BROADCAST_BYTES, Profile
from inkfold.operators.metadata import PREFIX, unsized, with_metadata
from inkfold.plans.definition import DEFAULT, MetadataDefinition
from inkfold.sources.tables import UNID

TEXT = "text"

Parser = Callable[[bytes], str | None]


class BlankDocument(Exception):
    """A parser may raise this instead of returning a blank text."""


def parsed(content: Column, parser: Parser) -> Column:
    """Text of binary contents by a caller's parser, in Arrow batches. Other errors fail the query."""

    def parse_one(data):
        if data is None:
            return None
        try:
            return parser(bytes(data))
        except BlankDocument:
            return None

    @F.pandas_udf("string")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(parse_one).astype(object)

    # Otherwise the blank filter would be pushed below the projection and parse everything again.
    return parse.asNondeterministic()(content)


def select_nonblank(rows: DataFrame, keep: list[Column], text: Column, extra: Iterable[Column] = ()) -> DataFrame:
    """``keep``, the text and ``extra`` of every row whose text is not blank.

    A plain filter on the text would be pushed down and compute the text twice. Unnesting the text out of
    an array that is empty for a blank one computes it once.
    """
    kept = F.filter(F.array(text), not_blank)
    return rows.select(*keep, F.explode(kept).alias(TEXT), *extra)


def _columns(names: Iterable[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


@dataclass(frozen=True)
class Extract:
    """Rows to turn into documents: their text, the bytes behind it, and their metadata."""

    rows: DataFrame
    text: Column
    content: Column
    metadata: list[Column]
    sizes: tuple[str, ...] = ()

    def documents(self, keep: Iterable[str], parser: Parser | None = None) -> DataFrame:
        """The columns to keep, the text and the metadata of every row that is not blank. ``sizes`` are metadata columns that
        hold the bytes of the text."""
        if parser is None:
            made = select_nonblank(self.rows, _columns(keep), self.text, self.metadata)
        else:
            text = parsed(self.content, parser).alias(TEXT)
            made = self.rows.select(*_columns(keep), text, *self.metadata).where(not_blank(F.col(TEXT)))
        return made.withColumns({name: F.octet_length(TEXT).cast(made.schema[name].dataType) for name in self.sizes})

    def observed(self, counter: Observation) -> Extract:
        return replace(self, rows=self.rows.observe(counter, F.count(F.lit(1)).alias("rows")))


def extract_fields(
    notes: DataFrame, definition: MetadataDefinition, fields: Iterable[str], failures: Observation | None = None
) -> Extract:
    text, sizes = fields_text(notes, fields), unsized(notes, definition)
    notes, metadata = with_metadata(notes, definition, failures=failures)
    return Extract(notes, text, text.cast("binary"), metadata, sizes)


def extract_attachments(
    notes: DataFrame,
    definition: MetadataDefinition,
    attachments: DataFrame | str = "attachments",
    pattern: str | None = None,
    keep: Iterable[str] = (UNID,),
    limit: int = BROADCAST_BYTES,
    notes_profile: Profile | None = None,
    failures: Observation | None = None,
) -> Extract:
    """Attachments with matching names beside their note's columns.

    ``attachments`` is a long table, or the name of an array column of the notes.
    """
    # Metadata is computed once per note, ahead of the attachments.
    notes, metadata = with_metadata(notes, definition, failures=failures)
    sides = [*_columns(keep), *metadata]
    if isinstance(attachments, str):
        rows = unnest_attachments(notes.select(*sides, F.col(f"`{attachments}`")), attachments, pattern or DEFAULT_GLOB)
    else:
        long = matching(attachments, pattern).select(UNID, ATT_POS, NAME, CONTENT)
        rows = join_attachments(notes.select(*sides), long, limit, notes_profile)
    rows = rows.withColumnRenamed(NAME, ATTACHMENT)
    metadata = _columns(PREFIX + field.name for field in definition)
    return Extract(rows, decode_utf8(F.col(CONTENT)), F.col(CONTENT), metadata)


def field_documents(
    notes: DataFrame,
    definition: MetadataDefinition,
    fields: Iterable[str],
    keep: Iterable[str] = (UNID,),
    parser: Parser | None = None,
) -> DataFrame:
    """One document per note with any text in the named fields. Narrow: no shuffle, also on a stream."""
    return extract_fields(notes, definition, fields).documents(keep, parser)


def attachment_documents(
    notes: DataFrame,
    definition: MetadataDefinition,
    attachments: DataFrame | str = "attachments",
    pattern: str | None = None,
    keep: Iterable[str] = (UNID,),
    parser: Parser | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """One document per attachment whose name matches, with the metadata of its note."""
    found = extract_attachments(notes, definition, attachments, pattern, keep, limit)
    return found.documents([*keep, ATT_POS, ATTACHMENT], parser)


def field_source(
    note: DataFrame, fields: Iterable[str] | str, definition: MetadataDefinition | None = None
) -> DataFrame:
    """Text and metadata of notes as they are, blank texts included."""
    names = [fields] if isinstance(fields, str) else list(fields)
    definition = DEFAULT if definition is None else definition
    text, sizes = fields_text(note, names).alias(TEXT), unsized(note, definition)
    note, metadata = with_metadata(note, definition)
    made = note.select(text, *metadata)
    return made.withColumns({name: F.octet_length(TEXT).cast(made.schema[name].dataType) for name in sizes})


def attachment_source(
    note: DataFrame, attachments: DataFrame, name: str, definition: MetadataDefinition | None = None
) -> DataFrame:
    """The bytes of one named attachment of each note, with the note's metadata."""
    definition = DEFAULT if definition is None else definition
    note, metadata = with_metadata(note, definition)
    sides = note.select(UNID, *metadata)
    place = [c for c in attachments.columns if c.lower() == ATT_POS]
    found = named_attachment(sides, attachments.select(UNID, *place, NAME, CONTENT), name)
    return found.select(F.col(CONTENT), *_columns(c for c in sides.columns if c != UNID))
