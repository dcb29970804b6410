import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkfold.llm import periods
from inkfold.llm.queries import QUERIES
from tests.llm.helpers import documents, empty

SF = "/root/testdata/sf0.01"


def brute(words):
    """All runs (start, length, period), by looking at every period and place."""
    n, found = len(words), {}
    codes = np.unique(words, return_inverse=True)[1] if n else np.empty(0, int)
    for q in range(1, n // 4 + 1):
        same = np.concatenate(([False], codes[:-q] == codes[q:], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(6, 4 * q):
                found.setdefault((a, b - a + q), q)  # the least period comes first
    return sorted((a, n, q) for (a, n), q in found.items())


def collapsed(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plant(id, words):
    h = zlib.crc32(str(id).encode())
    g, n = h // 10, len(words)
    if id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def strings():
    """Made to have many runs of all kinds: few letters, powers of powers, runs that begin and end near one another."""
    made = random.Random(4)
    for n in range(0, 26):
        for letters in "ab", "abc":
            yield [made.choice(letters) for _ in range(n)]
    for _ in range(150):
        words = []
        while len(words) < 400:
            root = [made.choice("abcdef") for _ in range(made.choice([1, 1, 2, 3, 5, 8, 13, 30, 61]))]
            if made.random() < 0.3:
                root = root * made.randint(2, 4) + [made.choice("ab")]
            words += (root * made.choice([1, 2, 3, 4, 5, 9]))[: made.randint(1, 300)]
        yield words
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    yield list(fib[-1])
    thue = "a"
    while len(thue) < 2048:
        thue += "".join("b" if c == "a" else "a" for c in thue)
    yield list(thue)
    yield list(thue * 5)
    yield ["x"] * 5000
    yield ["x", "y"] * 1500 + ["x"] * 900


def runs_of(words):
    parts = {}
    for f in periods._solved([periods.numbered(words)])[0]:
        parts.setdefault(f["period"], []).append((f["start"], f["end"]))
    found = []
    for q, spans in parts.items():
        held = []
        for a, b in sorted(spans):
            if held and a <= held[-1][1]:
                held[-1][1] = max(held[-1][1], b)
            else:
                held.append([a, b])
        found += [(a, b - a + q, q) for a, b in held]
    return sorted(found)


@pytest.mark.parametrize("tile", [1 << 15, 16])
def test_against_brute_force(monkeypatch, tile):
    monkeypatch.setattr(periods, "TILE", tile)
    monkeypatch.setattr(periods, "SHARED", 10 if tile > 16 else 2)
    for words in strings():
        assert runs_of(list(map(str.encode, words))) == brute(words), words[:40]


def test_hashes_decide_nothing(monkeypatch):
    """With hashes that are often equal by chance the runs are the same."""
    real = periods._Line.hashed
    monkeypatch.setattr(periods._Line, "hashed", lambda self, at, n: real(self, at, n) & np.uint64(3))
    for words in list(strings())[50:90]:
        assert runs_of(list(map(str.encode, words))) == brute(words)


def test_many_documents_at_once():
    lists = [list(map(str.encode, w)) for w in strings()]
    together = periods._solved([periods.numbered(w) for w in lists])
    for words, found in zip(lists, together):
        key = lambda f: (f["period"], f["start"], f["end"])
        assert sorted(map(key, found)) == sorted(map(key, periods._solved([periods.numbered(words)])[0]))


def test_tiles_see_every_zone(monkeypatch):
    """Any zone of three periods is within a tile of its octave, or over three periods of it at every cut."""
    monkeypatch.setattr(periods, "TILE", 64)
    for n in (6, 63, 64, 65, 500, 5000, 40_000):
        tiles = list(periods.tiles_of(n))
        for octave in range((n // 4).bit_length() if n >= 6 else 0):
            own = [(a, b) for low, high, a, b in tiles if low <= octave < high]
            assert own[0][0] == 0 and own[-1][1] == n
            assert all(b0 - a1 >= 14 << octave for (_, b0), (a1, _) in zip(own, own[1:]))


def test_time_grows_with_the_words():
    """Also where every period repeats: one word alone, words of two letters, a text made of one page."""
    made = random.Random(1)
    page = [str(made.random()) for _ in range(7000)]
    for words in (["x"] * 100_000, list("ab" * 50_000), page * 14):
        at = time.perf_counter()
        assert len(runs_of(list(map(str.encode, words)))) == 1
        assert time.perf_counter() - at < 20


def check(found, docs, prepare=lambda i, w: w):
    want = []
    for i, text in docs:
        words = prepare(i, [w.decode() for w in (text or "").encode().split()])
        runs = brute(words)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        want.append((i is None, i or 0, len(words), runs, sha(lines), sha(collapsed(words, runs))))
    got = [(r.id is None, r.id or 0, r.n_words, [tuple(x) for x in r.runs], r.runs_sha256, r.collapsed_sha256) for r in found]
    assert sorted(got) == sorted(want)


def test_odd_rows(spark):
    docs = documents(spark)
    found = periods.periodic_runs(docs).collect()
    check(found, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert all(sha(r.collapsed) == r.collapsed_sha256 for r in found)
    assert periods.periodic_runs(empty(spark)).collect() == []


def test_dealt_documents(spark, monkeypatch):
    """Long documents, their tiles dealt over tasks; a third of the rows is one document."""
    made = random.Random(2)
    long = " ".join(made.choice("abcdefgh") for _ in range(500)) + " a b c d e" * 90 + " q" * 700
    rows = [(i, long + f" {i % 7}") for i in range(12)] + [(50, long)] * 6 + [(60, "short"), (None, long)]
    whole = periods.periodic_runs(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    check(whole, rows)
    monkeypatch.setattr(periods, "DEALT_WORDS", 300)
    check(periods.periodic_runs(spark.createDataFrame(rows, "doc_id LONG, text STRING"), _small_tiles).collect(), rows)
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    kept = periods._searched(docs.selectExpr("monotonically_increasing_id() AS row", "doc_id AS id", "text"), _small_tiles, True)
    assert kept.where("low IS NOT NULL").groupBy("row").count().where("count > 4").count() == 19
    tiles = kept.where("low IS NOT NULL").select("row", "low", "high", "start", "words")
    by_row = {}
    for r in periods.stitched(periods._solved_tiles(tiles)).collect():
        by_row.setdefault(r.row, []).append((r.start, r.length, r.period))
    names = {r.row: r.n for r in kept.where("low IS NULL").collect()}
    want = sorted([(a, n, q) for a, n, q in brute(t.split())] for _, t in rows)
    assert sorted(sorted(by_row.get(r, [])) for r in names) == want


def _small_tiles(id, words):
    """Words as they are, after making the tiles of this worker small."""
    import importlib

    module = importlib.import_module("inkfold.llm.periods")
    module.TILE, module.SHARED = 128, 3
    return words


def test_query(spark):
    found = QUERIES["op13_periodic_runs"](spark, SF)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    planted = 0
    for i, text in docs:
        words = plant(i, [w.decode() for w in (text or "").encode().split()])
        runs = brute(words)
        planted += words != (text or "").split() and bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert got[i] == (len(runs), *four, sha(lines), sha(collapsed(words, runs))), i
    assert len(got) == len(docs) == found.count() and planted > 20
    assert found.where(F.col("n_runs") > 0).count() > planted / 2
