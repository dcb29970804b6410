"""Attachments that are files in a tree of folders, read where and when their contents are needed.

Listing them reads names, lengths and times, never a byte of a file. What is known of a name before its file is opened keeps it from being
opened: a glob becomes a filter of the listing, lengths and times become predicates of the scan, and folders named by column are pruned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions.names import DEFAULT_GLOB, glob_to_regex, matches_glob
from inkfold.sources.tables import UNID

# The columns of a note's attachments, and what a file has besides.
ATT_POS, NAME, CONTENT, LENGTH, MODIFIED = "att_pos", "name", "content", "length", "modified"

#: What opening a file counts in a task's share of bytes: a task takes up to 2,000 small files.
OPEN_BYTES = 64 << 10

_PLACEHOLDERS = {"{unid}": "([^/]+)", "{pos}": "([0-9]+)", "{name}": "([^/]+)"}
# Fixed value: the name of a folder whose column has no value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Folders up to which Spark is left to find their columns.
PARSED_FOLDERS = 10_000
# Upper-case letters beyond ASCII whose lower case is, or begins with, an ASCII letter.
_OTHER_CAPITALS = {"i": "İ", "k": "K"}


def path_glob(glob: str | None) -> str:
    """A case-sensitive glob for the names of files that lets through every name the glob matches without regard to case.

    It may let through more: classes, escapes, ``?`` and what is not a plain character become ``*``.
    """
    glob = (glob or DEFAULT_GLOB).lower()
    glob_to_regex(glob)  # refuses a bad glob
    out, i, in_braces = [], 0, False
    while i < len(glob):
        char = glob[i]
        if char == "[":
            i = glob.index("]", i + 1)
        i += char == "\\"
        if char.isascii() and char.isalpha():
            out.append(f"[{char}{char.upper()}{_OTHER_CAPITALS.get(char, '')}]")
        elif char == "{" or in_braces and char in ",}":
            in_braces = char != "}"
            out.append(char)
        elif char.isascii() and (char.isdigit() or char in "._- "):
            out.append(char)
        else:
            out.append("*")
        i += 1
    return re.sub(r"\*+", "*", "".join(out))


def _bound_tasks(spark: SparkSession) -> None:
    """Sets the session's cost of opening a file, if it is higher: at Spark's own, a task takes some 30 files, however small they are."""
    name = "spark.sql.files.openCostInBytes"
    if int(spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()) > OPEN_BYTES:
        spark.conf.set(name, str(OPEN_BYTES))


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders that are listed meanwhile are dealt over some tasks for each core, not one for each folder, and keys made of digits
    stay as they are written. The session's settings come back after."""
    settings = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@dataclass(frozen=True)
class FileStore:
    """Attachments below ``path``, on any file system that Spark reads.

    ``layout`` says where a file's path has the key of its note, its name and, if at all, its position among the note's attachments: the last
    parts of the path, such as ``{unid}/{name}`` or ``mail/{unid}/{pos}-{name}``. Files whose paths are made otherwise are not
    attachments. Without a layout folders are named by column, as Spark writes them: ``unid=.../att_pos=.../name=.../file``
    (``att_pos`` may be absent), and a key or a name prunes folders. A missing position is 0.

    ``least_bytes``, ``most_bytes``, ``changed_from`` and ``changed_before`` (the first two and ``changed_from`` inclusive) bound files before
    they are opened. Spark does not list empty files, whose text would be blank, nor files whose names begin with ``_`` or ``.``, unless
    the layout begins their names otherwise.
    """

    path: str
    layout: str | None = "{unid}/{name}"
    least_bytes: int | None = None
    most_bytes: int | None = None
    changed_from: datetime | None = None
    changed_before: datetime | None = None

    def __post_init__(self):
        if not self.path:
            raise ValueError("a path is needed to find files")
        if self.layout is not None:
            named = re.findall(r"\{[^}]*\}", self.layout)
            if sorted(set(named)) != sorted(named) or not {"{unid}", "{name}"} <= set(named) <= set(_PLACEHOLDERS):
                raise ValueError(f"a layout names {{unid}} and {{name}} and may name {{pos}}, each once: {self.layout!r}")

    def attachments(self, spark: SparkSession, pattern: str | None = None) -> DataFrame:
        """``(unid, att_pos, name, length, modified, content)`` of the files whose names match, all files without a pattern.

        Nothing is opened until ``content`` is used. The session's cost of opening a file is lowered, so that tasks are as many as needed
        for the files' bytes and not for their number.
        """
        _bound_tasks(spark)
        found = self._in_columns(spark) if self.layout is None else self._in_paths(spark, pattern)
        if pattern is not None:
            found = found.where(matches_glob(F.col(NAME), pattern))
        for bound, holds in (
            (self.least_bytes, lambda v: F.col(LENGTH) >= v),
            (self.most_bytes, lambda v: F.col(LENGTH) <= v),
            (self.changed_from, lambda v: F.col(MODIFIED) >= F.lit(v)),
            (self.changed_before, lambda v: F.col(MODIFIED) < F.lit(v)),
        ):
            found = found if bound is None else found.where(holds(bound))
        return found

    def _in_paths(self, spark: SparkSession, pattern: str | None) -> DataFrame:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        last = self.layout.rsplit("/", 1)[-1]
        if pattern is not None and "{name}" in last:
            head, tail = last.split("{name}")
            around = [re.sub(r"\{\w+\}|[^A-Za-z0-9._ -]", "*", part) for part in (head, tail)]
            reader = reader.option("pathGlobFilter", around[0] + path_glob(pattern) + around[1])
        pieces = re.split(r"(\{\w+\})", self.layout)
        regex = "(?s)/" + "".join(_PLACEHOLDERS.get(piece) or re.escape(piece) for piece in pieces) + r"\z"
        group = {piece: n for n, piece in enumerate((p for p in pieces if p in _PLACEHOLDERS), 1)}

        def part(name: str):
            return F.regexp_extract("path", regex, group[name])

        position = part("{pos}").cast("int") if "{pos}" in group else F.lit(0)
        with _listing(spark):
            files = reader.load(self.path).where(F.col("path").rlike(regex))
        return files.select(
            part("{unid}").alias(UNID), position.alias(ATT_POS), part("{name}").alias(NAME), LENGTH, F.col("modificationTime").alias(MODIFIED), CONTENT
        )

    def _in_columns(self, spark: SparkSession) -> DataFrame:
        """Spark finds the columns of folders in time that grows with the square of their number. Where they are many, columns are taken from
        the files' paths as the listing has them; so filters of these, too, keep files from being opened."""
        with _listing(spark):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path)
        if len(files._jdf.inputFiles()) > PARSED_FOLDERS:
            return self._in_many_columns(files)
        with _listing(spark):
            files = spark.read.format("binaryFile").option("basePath", self.path).load(self.path)
        named = {c.lower() for c in files.columns}
        file = [LENGTH, F.col("modificationTime").alias(MODIFIED), CONTENT]
        if {UNID, NAME} <= named:
            position = F.col(ATT_POS).cast("int") if ATT_POS in named else F.lit(0)
            return files.select(UNID, position.alias(ATT_POS), NAME, *file)
        if files.select(F.lit(1)).isEmpty():
            return files.select(F.lit("").alias(UNID), F.lit(0).alias(ATT_POS), F.lit("").alias(NAME), *file)
        raise ValueError(f"folders below {self.path} are not named by {UNID} and {NAME}")

    def _in_many_columns(self, files: DataFrame) -> DataFrame:
        path = F.col("_metadata.file_path")
        named = [path.rlike(f"(?i)/{column}=[^/]*/") for column in (UNID, NAME)]
        if not files.where(~(named[0] & named[1])).select(F.lit(1)).isEmpty():
            raise ValueError(f"folders below {self.path} are not named by {UNID} and {NAME}")

        def part(column: str):
            # written twice in codes: as a folder's name, then as a URI
            found = F.regexp_extract(path, f"(?i)^.*/{column}=([^/]*)/", 1)
            return F.when(found != NO_VALUE, _uncoded(_uncoded(found)))

        position = F.when(path.rlike(f"(?i)/{ATT_POS}=[^/]*/"), part(ATT_POS).cast("int")).otherwise(F.lit(0))
        return files.select(
            part(UNID).alias(UNID), position.alias(ATT_POS), part(NAME).alias(NAME), LENGTH, F.col("modificationTime").alias(MODIFIED), CONTENT
        )


def _uncoded(text: Column) -> Column:
    """A text with the characters that ``%`` and two digits stand for; any other ``%`` and ``+`` are themselves."""
    return F.when(text.contains("%"), F.url_decode(F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25"))).otherwise(text)
