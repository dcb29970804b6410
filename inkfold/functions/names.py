"""Names: file-name globs as regular expressions, and text right of a separator."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the glob when none is given. It leaves out names without a dot.
DEFAULT_GLOB = "*.*"

_REGEX_SPECIALS = set(r"\.^$|?*+()[]{}-&~#")


def right_back_sql(expr: str, separator: str) -> str:
    """SQL for the text right of the last ``separator``, empty when it does not occur."""
    sep = "'" + separator.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CASE WHEN contains({expr}, {sep}) THEN substring_index({expr}, {sep}, -1) WHEN ({expr}) IS NOT NULL THEN '' END"


def _literal(char: str) -> str:
    return "\\" + char if char in _REGEX_SPECIALS else char


def _char_class(glob: str, start: int) -> tuple[str, int]:
    """Regex for the bracket expression opening at ``start``, and the index after it."""
    end = glob.find("]", start + 1)
    body = glob[start + 1 : end] if end >= 0 else ""
    negated = body.startswith("!")
    body = body[1:] if negated else body
    if end < 0 or body == "" or "/" in body:
        raise ValueError(f"bad bracket expression in glob {glob!r}")
    items, i = [], 0
    while i < len(body):
        # A hyphen stands for itself at either end of the brackets and is a range elsewhere.
        if i + 2 < len(body) and body[i + 1] == "-":
            low, high = body[i], body[i + 2]
            if low > high:
                raise ValueError(f"reversed range {low}-{high} in glob {glob!r}")
            items.append(f"{_literal(low)}-{_literal(high)}")
            i += 3
        else:
            items.append(_literal(body[i]))
            i += 1
    chars = "".join(items)
    # The path separator is never matched by a bracket expression.
    return (f"[^/{chars}]" if negated else f"(?!/)[{chars}]"), end + 1


def glob_to_regex(glob: str) -> str:
    r"""Anchored regex for a file-name glob.

    ``*`` and ``?`` stop at ``/``, ``**`` crosses it, ``[a-c]`` and ``[!a]`` are character classes,
    ``{a,b}`` are alternatives (not nested), and ``\`` takes the next character literally. A leading
    dot is an ordinary character. The end is ``\z`` because ``$`` also matches before a last newline.
    """
    out, i, in_braces = [], 0, False
    while i < len(glob):
        char = glob[i]
        if char == "\\":
            if i + 1 == len(glob):
                raise ValueError(f"glob {glob!r} ends in an escape")
            out.append(_literal(glob[i + 1]))
            i += 2
            continue
        if char == "[":
            regex, i = _char_class(glob, i)
            out.append(regex)
            continue
        if glob.startswith("**", i):
            out.append(".*")
            i += 2
            continue
        if char == "{":
            if in_braces:
                raise ValueError(f"nested braces in glob {glob!r}")
            in_braces = True
            out.append("(?:")
        elif char == "}" and in_braces:
            in_braces = False
            out.append(")")
        elif char == "," and in_braces:
            out.append("|")
        else:
            out.append({"*": "[^/]*", "?": "[^/]"}.get(char) or _literal(char))
        i += 1
    if in_braces:
        raise ValueError(f"unclosed brace in glob {glob!r}")
    return "(?s)\\A(?:" + "".join(out) + ")\\z"


def matches_glob(name: Column, glob: str | None = None) -> Column:
    """Case-insensitive glob match on a file name; the pattern defaults to ``*.*``."""
    # Both sides are lower-cased, the pattern's character classes included.
    return F.lower(name).rlike(glob_to_regex((glob or DEFAULT_GLOB).lower()))


_EXTENSION = re.compile(r".*\*\.([\w-]+)", re.S)


def glob_extension(glob: str | None) -> str | None:
    """The extension that every matching name has, in lower case, where the glob ends in ``*.`` and plain letters."""
    if not glob or any(c in glob for c in "{}[]\\"):
        return None
    found = _EXTENSION.fullmatch(glob)
    return found.group(1).lower() if found else None
