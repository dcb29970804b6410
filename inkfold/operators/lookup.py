"""Picking notes: by ordered keys, by view entries, one at a time, and several calls appended."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.operators.keyed import (
    BROADCAST_BYTES,
    Profile,
    few_keys,
    filter_pays,
    filtered_by_keys,
    fits,
    listed_profile,
    narrowed,
    profile,
    spread_join,
)
from inkfold.sources.tables import BATCH, NOTE_ID, POS, UNID, key_frame, open_path, open_table


def shared_columns(left: DataFrame, right: DataFrame, *but: str) -> list[str]:
    """Columns of ``right`` that ``left`` has too, names compared as Spark does."""
    known, apart = {c.lower() for c in left.columns}, {c.lower() for c in but}
    return [c for c in right.columns if c.lower() in known and c.lower() not in apart]


def fetch(notes: DataFrame, keys: DataFrame | Iterable, key: str = UNID, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The note behind each key with the key's columns (``pos``). Repeats are kept, misses dropped.

    ``keys`` is a driver-side list or a DataFrame with ``key`` and any columns that tell its rows apart. Notes with a
    column of the same name as one of these are refused: rename either. Rows come in no particular order; sort
    by ``pos`` where the order matters.
    """
    return fetch_bounded(notes, keys, key, limit)[0]


def fetch_bounded(
    notes: DataFrame, keys: DataFrame | Iterable, key: str = UNID, limit: int = BROADCAST_BYTES, known: Profile | None = None
) -> tuple[DataFrame, Callable[[], Profile]]:
    """``fetch()``, and a profile of its result by ``key`` that follows from those of the two sides.

    The keys are profiled once, the notes once where that is needed, and their join never.
    """
    if not isinstance(keys, DataFrame):
        keys = list(keys)
        known, keys = listed_profile(keys), key_frame(notes.sparkSession, keys, key)
    if shared := shared_columns(notes, keys, key):
        raise ValueError(f"notes and keys share the columns {shared}")
    keys = keys.where(F.col(key).isNotNull())
    of_keys = known or profile(keys, key)
    measured: list[Profile] = []

    def of_notes() -> Profile:
        if not measured:
            measured.append(profile(notes, key))
        return measured[0]

    def bound() -> Profile:
        return of_keys.times(of_notes())

    if fits(of_keys, limit) or few_keys(of_keys) is not None and of_keys.size < FEW_BYTES:
        # The notes, usually the large side, stay where they are.
        few = few_keys(of_keys)
        held = notes if few is None else narrowed(notes, key, few)
        return held.join(F.broadcast(keys), key), bound
    if fits(of_notes(), limit):
        return keys.join(F.broadcast(notes), key), bound
    if filter_pays(of_keys, of_notes()):
        notes = filtered_by_keys(notes, keys, key, of_keys.rows)
    return spread_join(keys, notes, key, of_keys, of_notes()), bound


# A list of few keys is broadcast up to this size, whatever the limit.
FEW_BYTES = 1024 * 1024


def fetch_entries(notes: DataFrame, entries: DataFrame, limit: int = BROADCAST_BYTES, pos: str = POS) -> DataFrame:
    """Open the note behind each view entry ``(pos, unid)``; entry positions are kept, under the name ``pos``."""
    return fetch(notes, entries.select(F.col(POS).alias(pos), UNID), UNID, limit)


def append(frames: Iterable[DataFrame], number: str = BATCH) -> DataFrame:
    """Frames one after the other, numbered in the column ``number``, which none of them may have already.

    Nothing is deduplicated; a column one frame lacks is NULL there.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("at least one source is needed")
    if any(c.lower() == number.lower() for frame in frames for c in frame.columns):
        raise ValueError(f"a frame has a column {number} of its own")
    numbered = [frame.withColumn(number, F.lit(n)) for n, frame in enumerate(frames)]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), numbered)


def lookup_note(
    spark: SparkSession | None = None,
    note: DataFrame | None = None,
    table: DataFrame | str | None = None,
    path: str | None = None,
    base: str | None = None,
    unid: str | None = None,
    note_id: int | None = None,
    at_once: bool = True,
) -> DataFrame:
    """The single note a caller asks for, as a frame of one row; ``ValueError`` when there is none.

    A note given directly is taken as it is. A path replaces a table, and a UNID goes before a note id. Unless
    ``at_once``, no job looks for the note here: the frame reads the notes once, and its query fails when there is none.
    """
    if note is not None:
        return note
    if spark is not None and path:
        notes = open_path(spark, path, base)
    elif table is not None:
        notes = open_table(spark, table) if isinstance(table, str) else table
    else:
        raise ValueError("a note, or a table or path to find it in, is needed")
    if unid:
        key, wanted = UNID, unid
    elif note_id is not None:
        key, wanted = NOTE_ID, note_id
    else:
        raise ValueError("a UNID or a note id is needed")
    found = notes.where(F.col(key) == wanted)
    message = f"no note with {'UNID ' + unid if unid else f'note id {note_id}'}"
    if not at_once:
        return _one_or_refused(found.limit(1), key, wanted, message)
    if found.select(F.lit(1)).isEmpty():
        raise ValueError(message)
    return found.limit(1)


def _one_or_refused(found: DataFrame, key: str, wanted: str | int, message: str) -> DataFrame:
    """The row of found, or an error in the query: the wanted key is a row of its own, which the note joins."""
    kind = "string" if isinstance(wanted, str) else "bigint"
    asked = found.sparkSession.createDataFrame([(wanted,)], f"__wanted {kind}")
    held = found.withColumn("__there", F.lit(True))
    missing = F.raise_error(F.lit(message)).cast("boolean")
    joined = asked.join(F.broadcast(held), asked["__wanted"] == held[key], "left").where(F.col("__there").isNotNull() | missing)
    return joined.select(*(held[f"`{c}`"] for c in found.columns))
