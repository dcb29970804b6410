import random

import pytest
from pyspark.sql import functions as F

from inkfold.functions.names import glob_to_regex, matches_glob

NAMES = ["a.txt", "A.TXT", "noext", ".hidden", "a.b.pdf", "dir/a.txt", "a.txt\n", "", "b.txt", "a+b(1).txt", "[x].txt", "é.txt"]


def taken(spark, pattern, names=NAMES):
    frame = spark.createDataFrame([(n,) for n in names], "name STRING")
    return [r[0] for r in frame.where(matches_glob(F.col("name"), pattern)).collect()]


@pytest.mark.parametrize(
    ("pattern", "expected"),
    [
        (None, ["a.txt", "A.TXT", ".hidden", "a.b.pdf", "a.txt\n", "b.txt", "a+b(1).txt", "[x].txt", "é.txt"]),
        ("", ["a.txt", "A.TXT", ".hidden", "a.b.pdf", "a.txt\n", "b.txt", "a+b(1).txt", "[x].txt", "é.txt"]),
        ("*.txt", ["a.txt", "A.TXT", "b.txt", "a+b(1).txt", "[x].txt", "é.txt"]),
        ("*.TXT", ["a.txt", "A.TXT", "b.txt", "a+b(1).txt", "[x].txt", "é.txt"]),
        ("*", [n for n in NAMES if "/" not in n]),
        ("**", NAMES),
        ("**.txt", ["a.txt", "A.TXT", "dir/a.txt", "b.txt", "a+b(1).txt", "[x].txt", "é.txt"]),
        ("?.txt", ["a.txt", "A.TXT", "b.txt", "é.txt"]),
        ("[A-B].txt", ["a.txt", "A.TXT", "b.txt"]),
        ("[!a].txt", ["b.txt", "é.txt"]),
        ("*.{pdf,hid*}", ["a.b.pdf", ".hidden"]),
        ("{a,b}.txt", ["a.txt", "A.TXT", "b.txt"]),
        (r"\[x\].txt", ["[x].txt"]),
        ("a+b(1).txt", ["a+b(1).txt"]),
        ("*.java", []),
        ("dir?a.txt", []),
        ("dir[+-9]a.txt", []),
    ],
)
def test_globs(spark, pattern, expected):
    assert sorted(taken(spark, pattern)) == sorted(expected)


@pytest.mark.parametrize("pattern", ["[a", "{a,b", "{a,{b}}", "a\\", "[]", "[!]", "[b-a]", "[a/b]"])
def test_malformed_globs_are_refused(pattern):
    with pytest.raises(ValueError):
        glob_to_regex(pattern)


def brute(pattern, name):
    """Matches by trying every way to split the name."""
    if not pattern:
        return not name
    if pattern.startswith("**"):
        return any(brute(pattern[2:], name[i:]) for i in range(len(name) + 1))
    if pattern[0] == "*":
        ends = next((i for i, c in enumerate(name) if c == "/"), len(name))
        return any(brute(pattern[1:], name[i:]) for i in range(ends + 1))
    if pattern[0] == "{":
        inner, rest = pattern[1:].split("}", 1)
        return any(brute(option + rest, name) for option in inner.split(","))
    if pattern[0] == "[":
        inner, rest = pattern[1:].split("]", 1)
        negated, chars = inner.startswith("!"), inner.lstrip("!")
        return bool(name) and name[0] != "/" and (name[0] in chars) != negated and brute(rest, name[1:])
    if pattern[0] == "?":
        return bool(name) and name[0] != "/" and brute(pattern[1:], name[1:])
    return bool(name) and name[0] == pattern[0] and brute(pattern[1:], name[1:])


def test_globs_against_brute_force(spark):
    rng = random.Random(7)
    pieces = ["*", "**", "?", "a", "b", ".", "/", "{a,b.}", "[ab]", "[!a]"]
    patterns = sorted({"".join(rng.choices(pieces, k=rng.randint(1, 5))) for _ in range(60)})
    names = sorted({"".join(rng.choices("ab./", k=rng.randint(0, 5))) for _ in range(300)})
    frame = spark.createDataFrame([(n,) for n in names], "name STRING")
    found = frame.select("name", *[matches_glob(F.col("name"), p).alias(str(i)) for i, p in enumerate(patterns)])
    for row in found.collect():
        for i, pattern in enumerate(patterns):
            assert row[i + 1] == brute(pattern, row[0]), (pattern, row[0])
