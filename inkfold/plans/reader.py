"""``DocumentReader``: describe what to load, then ``load()`` it as one lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkfold.functions.names import DEFAULT_GLOB
from inkfold.operators.attachments import ATT_POS, ATTACHMENT
from inkfold.operators.documents import Parser, extract_attachments, extract_fields
from inkfold.operators.keyed import BROADCAST_BYTES, Profile, listed_profile
from inkfold.operators.lookup import append, fetch_bounded
from inkfold.operators.metadata import PREFIX, needed_columns
from inkfold.operators.ordered import in_order
from inkfold.plans.definition import MetadataDefinition
from inkfold.sources.files import FileStore
from inkfold.sources.tables import BATCH, NOTE_ID, POS, UNID, key_frame, open_path, open_table

Keys = DataFrame | tuple

# The number of a source call and a key's position go under these names until the end, so that items of notes may be called
# batch and pos.
_BATCH, _POS = "__source_batch", "__source_pos"


@dataclass(frozen=True)
class DocumentReader:
    """Every method returns a new reader. Repeating a source method appends to what it named before.

    Where several kinds of source are named, the first of notes, view entries, UNIDs and note ids counts.
    The result has ``batch`` (which call a row comes from), ``pos`` for keyed sources, ``unid``, for
    attachments ``att_pos`` and ``attachment_name``, then ``text`` and the ``meta_*`` columns.
    """

    definition: MetadataDefinition
    field_names: tuple[str, ...] = ()
    with_attachments: bool = False
    attachment_table: DataFrame | FileStore | str = "attachments"
    file_pattern: str | None = None
    document_parser: Parser | None = None
    kept: tuple[str, ...] = ()
    note_frames: tuple[DataFrame, ...] = ()
    entry_frames: tuple[tuple[DataFrame, DataFrame | None], ...] = ()
    unid_keys: tuple[Keys, ...] = ()
    note_id_keys: tuple[Keys, ...] = ()
    table_handle: DataFrame | str | None = None
    path: str | None = None
    base: str | None = None
    format: str = "parquet"
    session: SparkSession | None = None
    broadcast_bytes: int = BROADCAST_BYTES
    counters: tuple[Observation, Observation] | None = None
    failures: Observation | None = None

    def __post_init__(self):
        if not isinstance(self.definition, MetadataDefinition):
            raise ValueError("a metadata definition is required")

    # What to read from each note

    def fields(self, *names: str) -> DocumentReader:
        return replace(self, field_names=(*self.field_names, *names))

    def attachments(self, table: DataFrame | FileStore | str | None = None, enabled: bool = True) -> DocumentReader:
        """Read attachments, from a long table, a store of files or an array column of the notes."""
        source = self.attachment_table if table is None else table
        return replace(self, with_attachments=enabled, attachment_table=source)

    def pattern(self, glob: str) -> DocumentReader:
        """Read only attachments with matching names. Switches attachments on."""
        return replace(self, with_attachments=True, file_pattern=glob)

    def parser(self, parser: Parser) -> DocumentReader:
        if parser is None:
            raise ValueError("a parser is required")
        return replace(self, document_parser=parser)

    def keep(self, *columns: str) -> DocumentReader:
        """Carry columns of the notes along unchanged."""
        return replace(self, kept=(*self.kept, *columns))

    def count_into(self, read: Observation, kept: Observation) -> DocumentReader:
        """Count notes or attachments read and documents kept while the result is computed, as ``rows``.

        The difference is the number of blank documents dropped.
        """
        return replace(self, counters=(read, kept))

    def count_failures(self, failures: Observation) -> DocumentReader:
        """Count while the result is computed, for each metadata field that is an expression, the notes on which it fails: it gives no
        value though the columns it names have one. The field is left out there and the document stays."""
        return replace(self, failures=failures)

    # Which notes to read

    def notes(self, *frames: DataFrame) -> DocumentReader:
        return replace(self, note_frames=(*self.note_frames, *frames))

    def entries(self, frame: DataFrame, of: DataFrame | None = None) -> DocumentReader:
        """View entries ``(pos, unid)`` of the table ``of``, which defaults to the reader's table."""
        return replace(self, entry_frames=(*self.entry_frames, (frame, of)))

    def table(self, handle: DataFrame | str) -> DocumentReader:
        return replace(self, table_handle=handle)

    def location(self, path: str, base: str | None = None, format: str = "parquet") -> DocumentReader:
        return replace(self, path=path, base=base, format=format)

    def on(self, session: SparkSession) -> DocumentReader:
        return replace(self, session=session)

    def unids(self, keys: DataFrame | Iterable[str]) -> DocumentReader:
        return replace(self, unid_keys=(*self.unid_keys, _as_keys(keys)))

    def note_ids(self, keys: DataFrame | Iterable[int]) -> DocumentReader:
        return replace(self, note_id_keys=(*self.note_id_keys, _as_keys(keys)))

    # Loading

    def load(self) -> DataFrame:
        if self.with_attachments and self.field_names:
            raise ValueError("fields and attachments cannot be read together")
        if not self.with_attachments and not self.field_names:
            raise ValueError("name at least one field, or read attachments")
        notes, bound = self._picked()
        place = {_BATCH: BATCH, _POS: POS} if _POS in notes.columns else {_BATCH: BATCH}
        own = {c.lower(): c for c in notes.columns}
        keep = [*place]
        if _POS not in place and POS in own:
            keep.append(own[POS])  # notes given directly may bring a position of their own
            place[own[POS]] = POS
        if UNID in own:
            keep.append(own[UNID])
            place[own[UNID]] = UNID
        keep += [c for c in self.kept if c.lower() not in {k.lower() for k in keep}]
        self._refuse_kept([c for c in keep if c not in place], [*place.values()])
        if self.with_attachments:
            renamed = notes.withColumnRenamed(own[UNID], UNID) if UNID in own else notes
            place, keep = {c: n for c, n in place.items() if n != UNID}, [UNID if c == own.get(UNID) else c for c in keep]
            table = self.attachment_table
            if isinstance(table, FileStore):
                table = table.attachments(notes.sparkSession, self.file_pattern or DEFAULT_GLOB)
            profile = bound() if bound and not isinstance(table, str) else None
            found = extract_attachments(
                renamed, self.definition, table, self.file_pattern, keep, self.broadcast_bytes, profile, self.failures
            )
            keep += [ATT_POS, ATTACHMENT]
        else:
            found = extract_fields(notes, self.definition, self.field_names, self.failures)
        if self.counters is None:
            return found.documents(keep, self.document_parser).withColumnsRenamed(place)
        read, kept = self.counters
        documents = found.observed(read).documents(keep, self.document_parser).withColumnsRenamed(place)
        return documents.observe(kept, F.count(F.lit(1)).alias("rows"))

    def _refuse_kept(self, kept: list[str], others: list[str]):
        """Columns to keep that have the name of another column of the result."""
        names = [*others, "text", *(PREFIX + field.name for field in self.definition)]
        names += [ATT_POS, ATTACHMENT] if self.with_attachments else []
        taken = {name.lower() for name in names}
        clashing = [c for c in kept if c.lower() in taken or c.lower() in (BATCH, POS)]
        if clashing:
            raise ValueError(f"columns to keep have the names of others of the result: {clashing}")

    def load_ordered(self) -> DataFrame:
        """``load()`` in source order, at the price of a shuffle of the result.

        Rows go by ``batch`` and ``pos``. Notes given without a ``pos`` have no order of their own and go by
        ``unid``; ``batch`` alone would send everything to one task. Where the tasks' shares begin is settled on the keys alone, so
        that texts are extracted, and parsed, once; then a note's attachments stay in one task. Attachments that no parser reads are cheap to
        compute again, and a note with very many of them is cut by ``att_pos`` instead.
        """
        documents = self.load()
        place = next((c for c in (POS, UNID) if c in documents.columns), None)
        if place is None:
            raise ValueError("notes need a pos or unid column to be put in order")
        order = [c for c in (BATCH, place, ATT_POS) if c in documents.columns]
        cheap = self.with_attachments and self.document_parser is None
        places = None if cheap else self._places(place)
        return documents.orderBy(*order) if places is None else in_order(documents, places, [BATCH, place], order)

    def _places(self, place: str) -> DataFrame | None:
        """The batch and place of every row there can be, from the notes or keys given; ``None`` where a key list does not tell."""
        if self.note_frames:
            return append(self.note_frames, _BATCH).select(F.col(_BATCH).alias(BATCH), F.col(place).alias(place))
        lists = [frame for frame, _ in self.entry_frames] or [keys for keys in self.unid_keys if isinstance(keys, DataFrame) or keys]
        key = UNID if lists else NOTE_ID
        lists = lists or [keys for keys in self.note_id_keys if isinstance(keys, DataFrame) or keys]
        session = self._notes_table().sparkSession if any(not isinstance(keys, DataFrame) for keys in lists) else None
        frames = [keys if isinstance(keys, DataFrame) else key_frame(session, keys, key) for keys in lists]
        if not all(any(c.lower() == place for c in frame.columns) for frame in frames):
            return None
        numbered = [frame.select(F.lit(number).alias(BATCH), F.col(place).alias(place)) for number, frame in enumerate(frames)]
        return reduce(DataFrame.unionAll, numbered)

    def _picked(self) -> tuple[DataFrame, Callable[[], Profile] | None]:
        """The notes to read, numbered by source call, and for view entries and UNIDs what bounds their number and size."""
        if self.note_frames:
            return append(self.note_frames, _BATCH), None
        if self.entry_frames:
            opened = None if all(of is not None for _, of in self.entry_frames) else self._notes_table()
            tables = [opened if of is None else of for _, of in self.entry_frames]
            return self._fetched(UNID, [frame for frame, _ in self.entry_frames], tables)
        # Without entries to bring their table along, ids need the reader's.
        opened = self._notes_table()
        for key, lists in ((UNID, self.unid_keys), (NOTE_ID, self.note_id_keys)):
            given = [keys for keys in lists if isinstance(keys, DataFrame) or keys]
            if given:
                return self._fetched(key, given, [opened] * len(given))
        raise ValueError("name the notes to read: notes, view entries, UNIDs or note ids")

    def _fetched(
        self, key: str, lists: list[Keys], tables: list[DataFrame]
    ) -> tuple[DataFrame, Callable[[], Profile] | None]:
        """Notes of several key lists, numbered by list. Lists for the same table share one scan of it."""
        by_table: dict[int, tuple[DataFrame, list[DataFrame], list[Keys]]] = {}
        for number, (keys, table) in enumerate(zip(lists, tables)):
            listed = not isinstance(keys, DataFrame)
            frame = key_frame(table.sparkSession, keys, key) if listed else keys
            place = [F.col(POS).alias(_POS)] if any(c.lower() == POS for c in frame.columns) else []
            numbered = frame.select(*place, F.col(key).alias(key), F.lit(number).alias(_BATCH))
            _, frames, given = by_table.setdefault(id(table), (table, [], []))
            frames.append(numbered)
            given.append(keys)
        fetched, bounds = [], []
        used = [UNID, key, *self.kept, *self.field_names]
        used += [self.attachment_table] if self.with_attachments and isinstance(self.attachment_table, str) else []
        for table, frames, given in by_table.values():
            listed = all(not isinstance(keys, DataFrame) for keys in given)
            known = listed_profile([k for keys in given for k in keys]) if listed else None
            frame, bound = fetch_bounded(
                needed_columns(table, self.definition, used),
                reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames),
                key,
                self.broadcast_bytes,
                known,
            )
            fetched.append(frame)
            bounds.append(bound)
        notes = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), fetched)
        return notes, (lambda: reduce(Profile.plus, [bound() for bound in bounds])) if key == UNID else None

    def _notes_table(self) -> DataFrame:
        """The table named by handle, else by path."""
        if isinstance(self.table_handle, DataFrame):
            return self.table_handle
        if self.table_handle is None and not self.path:
            raise ValueError("a table, or a session and a path, is needed to find notes")
        session = self.session or SparkSession.getActiveSession()
        if session is None:
            raise ValueError("a Spark session is needed to open a table")
        if self.table_handle is not None:
            return open_table(session, self.table_handle)
        return open_path(session, self.path, self.base, self.format)


def _as_keys(keys) -> Keys:
    return keys if isinstance(keys, DataFrame) else tuple(keys)


def load_documents(definition: MetadataDefinition, notes: DataFrame, *fields: str) -> DataFrame:
    """Documents from the named fields of a table of notes."""
    return DocumentReader(definition).notes(notes).fields(*fields).load()
