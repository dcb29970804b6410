"""HTML fragments to text as a column job: four regular-expression passes and one entity pass."""

from __future__ import annotations

import html.entities
import json
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that stand on their own line, so that a space separates them from
# their neighbours. All other tags are inline and leave nothing behind.
BLOCK_TAGS = (
    "address applet article aside blockquote body br canvas caption center col colgroup dd del details "
    "dir div dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html ins li link listing main marquee math menu meta nav noframes noscript ol p plaintext "
    "pre script section style svg table tbody td template tfoot th thead title tr ul video audio"
).split()


def _one_of(names: list[str]) -> str:
    """Alternatives grouped by first letter, so that most tags fail after a few comparisons."""
    groups = groupby(sorted(names), key=lambda name: name[0])
    return "|".join(f"{letter}(?:{'|'.join(name[1:] for name in group)})" for letter, group in groups)


# Every pattern starts with the one character '<', which lets the matcher skip text quickly. Quoted attribute
# values may hold '>'. The possessive quantifiers keep a tag that is never closed from costing more than one
# pass over it. A tag, comment or value that is never closed runs to the end of the text.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))?+)*+"""
_TAG_END = r"(?:>|\z)"
_TAG_REST = rf"(?:[\s/]{_ATTRIBUTES})?{_TAG_END}"

# Comments, declarations and the contents of script and style go; the closing tags of the latter two stay
# for the block pass.
_HIDDEN = (
    rf"(?is)<(?:!--.*?(?:-->|\z)|[!?][^>]*+{_TAG_END}"
    rf"|script{_TAG_REST}.*?(</script\s*>|\z)"
    rf"|style{_TAG_REST}.*?(</style\s*>|\z))"
)
_BLOCK = rf"(?i)</?(?:{_one_of(BLOCK_TAGS)}){_TAG_REST}"
_INLINE = rf"<(?:/?[A-Za-z]{_ATTRIBUTES}{_TAG_END}|/[^>]*+{_TAG_END})"
# Elements that hold text, in which nothing is a tag: 1 = start tag, 3 = text, 4 = the rest.
_TEXT_ONLY_AHEAD = r"(?i)(?=<(?:textarea|title)[\s/>])"
_TEXT_ONLY = rf"(?is)\A(<(textarea|title)(?:[\s/]{_ATTRIBUTES})?>)(.*?)(</\2(?=[\s/>]).*+|\z)"
# Characters that take no room, the zero-width space and the soft hyphen.
_INVISIBLE = ("\u200B", "\u00AD")
_SPACES = r"[ \t\n\f\r\u00A0]+"

# What follows the ampersand of a character reference: 1 = decimal, 2 = hexadecimal, 3 = name.
_REFERENCE = r"\A(?:#([0-9]++);?|#[xX]([0-9A-Fa-f]++);?|([A-Za-z][A-Za-z0-9]*;?))"
# The longest name that needs no ';' at the start of a run of letters.
_BARE_NAMES = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_BARE = rf"\A({'|'.join(_BARE_NAMES)})"
# The characters that the numbers 128 to 159 stand for, by Windows-1252, as a map literal of SQL.
_WINDOWS = "map({})".format(
    ", ".join(f"{n}, '{bytes([n]).decode('cp1252')}'" for n in range(128, 160) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
)

# Name to text, as JSON so that it folds into one map literal. Names without ';' are those that
# HTML allows to leave it out. A lookup goes through them in order: common characters first.
_NAMED = json.dumps(dict(sorted(html.entities.html5.items(), key=lambda item: (len(item[1]), item[1]))))

# The references that text is full of, tried before the map.
_FREQUENT = {"amp;": "&", "quot;": '"', "lt;": "<", "gt;": ">", "nbsp;": " "}


def _code_point(number: Column) -> Column:
    """The character of a code point; U+FFFD for what is not one."""
    valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    windows = F.expr(_WINDOWS)
    return (
        F.when(number.between(128, 159), F.coalesce(F.try_element_at(windows, number.cast("int")), char))
        .when(valid, char)
        .otherwise(F.lit("\uFFFD"))
    )


def _number(digits: Column, base: int) -> Column:
    """The number that all of the digits make; 0 for one too large for any character."""
    plain = F.ltrim(digits, F.lit("0"))
    return F.when(F.length(plain) > 7, F.lit(0)).otherwise(F.coalesce(F.conv(plain, base, 10).try_cast("bigint"), F.lit(0)))


def _decode_reference(rest: Column) -> Column:
    """Text that began with an ampersand, with the character reference there decoded if it is one."""
    named = F.from_json(F.lit(_NAMED), "map<string,string>")
    decimal = F.regexp_extract(rest, _REFERENCE, 1)
    hexadecimal = F.regexp_extract(rest, _REFERENCE, 2)
    char = (
        F.when(decimal != "", _code_point(_number(decimal, 10)))
        .when(hexadecimal != "", _code_point(_number(hexadecimal, 16)))
        .otherwise(F.try_element_at(named, F.regexp_extract(rest, _REFERENCE, 3)))
    )
    bare = F.regexp_extract(rest, _BARE, 1)
    cut = F.concat(F.try_element_at(named, bare), F.substr(rest, F.length(bare) + 1))
    decoded = F.coalesce(F.concat(char, F.regexp_replace(rest, _REFERENCE, "")), F.when(bare != "", cut))
    result = F
    for name, text in _FREQUENT.items():
        result = result.when(rest.startswith(name), F.concat(F.lit(text), F.substr(rest, F.lit(len(name) + 1))))
    return result.otherwise(F.coalesce(decoded, F.concat(F.lit("&"), rest)))


def decode_entities(text: Column) -> Column:
    """Named and numeric character references as characters, each decoded once."""
    # The text is named once here, else Spark would compute what it stands for again.
    pieces = F.split(text, "&")
    decoded = F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(_decode_reference(piece)))
    return F.array_join(decoded, "")


def _plain_contents(fragment: Column) -> Column:
    """What looks like a tag within elements that hold only text is written as references."""

    def escaped(piece: Column) -> Column:
        part = [F.regexp_extract(piece, _TEXT_ONLY, i) for i in (1, 3, 4)]
        return F.when(part[0] == "", piece).otherwise(F.concat(part[0], F.replace(part[1], F.lit("<"), F.lit("&lt;")), part[2]))

    return F.array_join(F.transform(F.split(fragment, _TEXT_ONLY_AHEAD), escaped), "")


def html_text(fragment: Column) -> Column:
    """Visible text of an HTML fragment with runs of white space as one space."""
    text = F.regexp_replace(_plain_contents(fragment), _HIDDEN, "$1$2")
    text = F.regexp_replace(text, _BLOCK, " ")
    text = F.regexp_replace(text, _INLINE, "")
    text = decode_entities(text)
    for invisible in _INVISIBLE:
        text = F.replace(text, F.lit(invisible), F.lit(""))
    return F.trim(F.regexp_replace(text, _SPACES, " "))
