"""Documents from a stream of notes.

Reading fields or nested attachments keeps no state and shuffles nothing, so the batch operators apply
to a streaming DataFrame unchanged; a late or repeated note is simply another document.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from inkfold.operators.documents import field_documents
from inkfold.plans.definition import MetadataDefinition
from inkfold.sources.tables import UNID


def stream_documents(
    notes: DataFrame, definition: MetadataDefinition, fields: Iterable[str], keep: Iterable[str] = (UNID,)
) -> DataFrame:
    """Documents of a stream of notes, ready for ``writeStream`` in append mode."""
    if not notes.isStreaming:
        raise ValueError("notes must be a streaming DataFrame")
    return field_documents(notes, definition, fields, keep)
