"""Which metadata a document carries: an ordered, immutable list of typed fields.

Each field is a Spark SQL expression over the columns of a note, so a definition compiles
into one ``select`` (see ``operators.metadata``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from inkfold.functions.names import right_back_sql

# The five types a metadata field can have.
FIELD_TYPES = ("string", "integer", "long", "double", "temporal")


@dataclass(frozen=True)
class MetaField:
    """One metadata field. Without an expression it reads the note column of the same name."""

    name: str
    expr: str
    type: str

    def __post_init__(self):
        for label, value in (("name", self.name), ("expression", self.expr)):
            if not isinstance(value, str) or value == "":
                raise ValueError(f"metadata field {label} must be a non-empty string, got {value!r}")
        if self.type not in FIELD_TYPES:
            raise ValueError(f"metadata field type must be one of {FIELD_TYPES}, got {self.type!r}")


# Tells "no expression given" from an explicit None, which is refused.
_SAME_AS_NAME = object()


@dataclass(frozen=True)
class MetadataDefinition:
    """Fields in output order. ``with_*`` methods return a new definition and leave this one alone.

    Naming a field again replaces its expression and type and keeps its first position.
    """

    fields: tuple[MetaField, ...] = ()

    def __post_init__(self):
        seen: dict[str, str] = {}
        for field in self.fields:
            other = seen.setdefault(field.name.lower(), field.name)
            if other != field.name:
                # Metadata names are case-sensitive keys, Spark columns are not.
                raise ValueError(f"metadata names {other!r} and {field.name!r} differ only in case")
        if len(seen) != len(self.fields):
            raise ValueError("metadata names must be unique within a definition")

    def __iter__(self) -> Iterator[MetaField]:
        return iter(self.fields)

    def __len__(self) -> int:
        return len(self.fields)

    def with_field(self, name, expr, type) -> MetadataDefinition:
        merged = {field.name: field for field in self.fields}
        merged[name] = MetaField(name, name if expr is _SAME_AS_NAME else expr, type)
        return MetadataDefinition(tuple(merged.values()))

    def with_string(self, name, expr=_SAME_AS_NAME) -> MetadataDefinition:
        return self.with_field(name, expr, "string")

    def with_integer(self, name, expr=_SAME_AS_NAME) -> MetadataDefinition:
        return self.with_field(name, expr, "integer")

    def with_long(self, name, expr=_SAME_AS_NAME) -> MetadataDefinition:
        return self.with_field(name, expr, "long")

    def with_double(self, name, expr=_SAME_AS_NAME) -> MetadataDefinition:
        return self.with_field(name, expr, "double")

    def with_temporal(self, name, expr=_SAME_AS_NAME) -> MetadataDefinition:
        return self.with_field(name, expr, "temporal")

    def extend(self, other: MetadataDefinition) -> MetadataDefinition:
        """This definition followed by ``other``, whose fields win where names repeat."""
        if not isinstance(other, MetadataDefinition):
            raise ValueError("a definition can only be extended with another definition")
        merged = {field.name: field for field in (*self.fields, *other.fields)}
        return MetadataDefinition(tuple(merged.values()))


def based_on(base: MetadataDefinition) -> MetadataDefinition:
    """Starting point for deriving a definition; ``None`` is refused."""
    if not isinstance(base, MetadataDefinition):
        raise ValueError("a base definition is required")
    return base


EMPTY = MetadataDefinition()

# A note id prints as NT followed by eight hex digits; the metadata keeps the digits.
NOTE_ID_TEXT = "'NT' || lpad(hex(CAST(note_id AS BIGINT) & 4294967295), 8, '0')"

# The nine metadata names and the system column each one reads.
DEFAULT = (
    EMPTY.with_string("form")
    .with_string("noteid", right_back_sql(NOTE_ID_TEXT, "NT"))
    .with_string("unid", "CAST(unid AS STRING)")
    .with_temporal("created")
    .with_temporal("addedtofile", "added_to_file")
    .with_temporal("lastmodified", "modified")
    .with_temporal("lastmodifiedinfile", "modified_in_file")
    .with_temporal("lastaccessed", "accessed")
    .with_integer("size")
)
