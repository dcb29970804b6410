"""Tables of notes in, text documents with typed metadata out, all as Spark DataFrames."""

from inkfold.operators.documents import (
    BlankDocument,
    attachment_documents,
    attachment_source,
    field_documents,
    field_source,
)
from inkfold.operators.lookup import append, fetch, fetch_entries, lookup_note
from inkfold.plans.definition import DEFAULT, EMPTY, MetadataDefinition, MetaField, based_on
from inkfold.plans.reader import DocumentReader, load_documents
from inkfold.session import build_session
from inkfold.sources.files import FileStore
from inkfold.sources.items import wide_notes

__all__ = [
    "DEFAULT",
    "EMPTY",
    "BlankDocument",
    "DocumentReader",
    "FileStore",
    "MetaField",
    "MetadataDefinition",
    "append",
    "attachment_documents",
    "attachment_source",
    "based_on",
    "build_session",
    "fetch",
    "fetch_entries",
    "field_documents",
    "field_source",
    "load_documents",
    "lookup_note",
    "wide_notes",
]
