"""Attachments of notes: listed, picked by name, matched by a file-name glob.

They live either in a long table ``(unid, att_pos, name, content)``, from which unneeded contents are
never read, or in an array column of the notes, which needs no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.functions.names import glob_extension, matches_glob
from inkfold.operators.keyed import (
    BROADCAST_BYTES,
    Profile,
    few_keys,
    filter_pays,
    filtered_by_keys,
    first_rows,
    fits,
    narrowed,
    profile,
    spread_join,
)
from inkfold.operators.lookup import shared_columns
from inkfold.sources.tables import UNID

ATT_POS, NAME, CONTENT, ATTACHMENT = "att_pos", "name", "content", "attachment_name"

# A column that an attachments table may have: what follows the last dot of a name, in lower case, NULL without a dot.
EXTENSION = "extension"


def _refuse_shared_columns(notes: DataFrame, attachments: DataFrame):
    if shared := shared_columns(notes, attachments, UNID):
        raise ValueError(f"notes and attachments share the columns {shared}")


def join_attachments(
    notes: DataFrame, attachments: DataFrame, limit: int = BROADCAST_BYTES, notes_profile: Profile | None = None
) -> DataFrame:
    """Each attachment with the columns of its note. Contents are shuffled only when the notes' columns are too
    large to broadcast, then only those of wanted notes where these are few, and the notes only those that have an attachment. ``notes_profile`` saves measuring them."""
    _refuse_shared_columns(notes, attachments)
    of_notes = notes_profile or profile(notes, UNID)
    if fits(of_notes, limit):
        few = few_keys(of_notes)
        held = attachments if few is None else narrowed(attachments, UNID, few)
        return held.join(F.broadcast(notes), UNID)
    # A note can have very many attachments, and a key list can name one note very often.
    keys = attachments.select(UNID)
    of_files = profile(keys, UNID)
    few = few_keys(of_files)
    if few is not None:
        notes = narrowed(notes, UNID, few)
    elif fits(of_files, limit):
        notes = notes.join(F.broadcast(keys.distinct()), UNID, "left_semi")
    elif filter_pays(of_files, of_notes):
        notes = filtered_by_keys(notes, keys, UNID, of_files.rows)
    if filter_pays(of_notes, of_files):
        attachments = filtered_by_keys(attachments, notes.select(UNID), UNID, of_notes.rows)
    return spread_join(attachments, notes, UNID, of_files, of_notes)


def unnest_attachments(notes: DataFrame, column: str = "attachments", pattern: str | None = None) -> DataFrame:
    """Attachments held in an array column, one row each with the other columns of the note.

    With a pattern, names are matched within the array, so that only attachments that match become rows; they keep their positions.
    """
    others = [F.col(f"`{c}`") for c in notes.columns if c.lower() != column.lower()]
    if pattern is None:
        rows = notes.select(*others, F.posexplode(F.col(f"`{column}`")).alias(ATT_POS, "__att"))
    else:
        placed = F.transform(F.col(f"`{column}`"), lambda file, at: F.struct(at.alias(ATT_POS), file.alias("file")))
        matched = F.filter(placed, lambda placed: matches_glob(placed["file"][NAME], pattern))
        rows = notes.select(*others, F.explode(matched).alias("__placed"))
        rows = rows.select(*others, F.col(f"__placed.{ATT_POS}").alias(ATT_POS), F.col("__placed.file").alias("__att"))
    return rows.select(
        *[F.col(f"`{c}`") for c in rows.columns if c != "__att"],
        F.col(f"__att.{NAME}").alias(NAME),
        F.col(f"__att.{CONTENT}").alias(CONTENT),
    )


def list_attachments(notes: DataFrame, attachments: DataFrame | None = None) -> DataFrame:
    """Position and name of every attachment of every note."""
    if attachments is None:
        return unnest_attachments(notes).select(UNID, ATT_POS, NAME)
    return join_attachments(notes.select(UNID), attachments.select(UNID, ATT_POS, NAME))


def matching(attachments: DataFrame, pattern: str | None = None) -> DataFrame:
    """Attachments whose name matches the glob, before anything touches their contents.

    Names are matched row by row, so the scan skips nothing by itself. A table with a column ``extension``, best as a
    partition or sort column, is also filtered by that where the pattern ends in a literal extension.
    """
    found = attachments
    ending = glob_extension(pattern)
    if ending is not None and any(c.lower() == EXTENSION for c in attachments.columns):
        found = found.where(F.col(EXTENSION) == ending)
    return found.where(matches_glob(F.col(NAME), pattern))


def named_attachment(
    notes: DataFrame, attachments: DataFrame, name: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The attachment of exactly this name for every note, of several the one with the lowest ``att_pos``. The query
    fails if a note has none.

    The file is found by its place, then its contents are looked up and stream past the notes; they are never sorted."""
    if not name:
        raise ValueError("an attachment name must not be empty")
    _refuse_shared_columns(notes, attachments)
    picked = attachments.where(F.col(NAME) == name)
    keys = notes.select(UNID)
    of_keys = profile(keys, UNID)
    few, bound = few_keys(of_keys), None
    if few is not None:
        picked, bound = narrowed(picked, UNID, few), of_keys
    elif fits(of_keys, limit):
        # An outer join cannot broadcast the notes, but their keys leave little of the other side.
        picked, bound = picked.join(F.broadcast(keys.distinct()), UNID, "left_semi"), of_keys
    others = [c for c in picked.columns if c.lower() != UNID]
    place = next((c for c in others if c.lower() == ATT_POS), None)
    first = first_rows(picked, UNID, place, {"__file": F.col(NAME) == name}, others, limit, bound=bound)
    missing = F.raise_error(F.lit(f"attachment not found: {name}")).cast("boolean")
    joined = spread_join(notes, first, UNID, of_keys, how="left", hashed="left").where(F.col("__file").isNotNull() | missing)
    return joined.select(*[F.col(f"`{c}`") for c in notes.columns], *[F.col(f"__file.`{c}`").alias(c) for c in others])
