"""Notes kept one row per item, for records that share no schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.functions.text import ITEM_PARTS
from inkfold.operators.keyed import BROADCAST_BYTES, first_rows
from inkfold.sources.tables import UNID


def wide_notes(
    items: DataFrame,
    names: Iterable[str],
    key: str = UNID,
    notes: DataFrame | None = None,
    clustered: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per note with a column for each named item, from ``(unid, item_pos, name, kind, vals, ...)``.

    Names match without regard to case. Of several items of one name the first counts, a missing one is NULL. An item
    has its values in ``vals`` (strings), ``numbers`` or ``times``. With ``notes``, one row per note with its system
    values, every note is kept, also one without items; else notes with none of the items are left out. First items are found by
    name and position alone; bodies are looked up then and dealt by note without a sort. ``clustered`` says that the table is
    bucketed by ``key``, which saves dealing them.
    """
    wanted = list({name.lower(): name for name in names}.values())
    if not wanted:
        raise ValueError("name at least one item")
    parts = [part for part in ITEM_PARTS if part in {c.lower() for c in items.columns}]
    slots = {n: F.lower("name") == n.lower() for n in wanted}
    wide = first_rows(items, key, "item_pos", slots, parts, limit, clustered)
    if notes is None:
        return wide
    if shared := [c for c in notes.columns if c.lower() in {n.lower() for n in wanted} and c.lower() != key.lower()]:
        raise ValueError(f"notes and items share the names {shared}")
    # Bodies stream past the notes.
    return notes.hint("shuffle_hash").join(wide, key, "left")
