import hashlib
import random
import re

import pytest

from inkfold.llm import decontaminate as d
from inkfold.llm.queries import QUERIES
from tests.llm.helpers import SF, documents, empty, rows


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, window=13):
    own = words(text)
    hit, found = set(), set()
    for name, item in items:
        parts = words(item)
        n = min(window, len(parts))
        wins = {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(name)
    return len(own), len(hit), sorted(str(name) for name in found if name is not None)


@pytest.mark.parametrize("shard", [200_000, 3])
def test_against_brute_force(spark, shard):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    items = [(i, text(rng.randint(0, 20))) for i in range(12)] + [(3, None), (None, "a b c"), (5, "a, B. c! 7"), (5, "a b")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id LONG, text STRING")
    frame = spark.createDataFrame(docs, "doc_id LONG, text STRING")
    for window in (2, 4, 13):
        found = d.contamination(frame, bench, window=window, automaton_words=shard)
        got = {r.id: (r.n_words, sum(s.end - s.start for s in r.spans), list(r["items"])) for r in found.collect()}
        assert got == {i: brute(t, items, window) for i, t in docs}


def test_an_item_without_id_hits(spark):
    """Its windows are hit, it is not named; two of them count for nothing."""
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(1, text), (2, "clean words only"), (3, "x " + text + " short item y")], "doc_id LONG, text STRING")
    bench = spark.createDataFrame([(None, text), (None, text), (7, "short item")], "item_id LONG, text STRING")
    for shard in (200_000, 20):
        got = sorted((r.id, r.n_words, sum(s.end - s.start for s in r.spans), list(r["items"])) for r in d.contamination(docs, bench, automaton_words=shard).collect())
        assert got == [(1, 14, 14, []), (2, 3, 0, []), (3, 18, 16, ["7"])]
        assert [r.doc_id for r in d.keep_clean(docs, bench, automaton_words=shard).collect()] == [2]


def test_odd_texts(spark):
    docs, bench = documents(spark), spark.sql("SELECT 1L AS item_id, 'quick brown FOX' AS text UNION ALL SELECT 2L, '' UNION ALL SELECT 3L, '東京'")
    found = d.contamination(docs, bench)
    got = sorted((str(r.id), r.n_words, sum(s.end - s.start for s in r.spans), list(r["items"])) for r in found.collect())
    want = sorted((str(r.doc_id), *brute(r.text, [(1, "quick brown fox"), (3, "東京")])) for r in docs.collect())
    assert got == want
    assert d.contamination(empty(spark), bench).collect() == []
    assert all(r.spans == [] for r in d.contamination(docs, bench.where("false")).collect())


def test_clean_rows_stay_as_they_are(spark):
    docs, bench = documents(spark), spark.sql("SELECT 1L AS item_id, 'quick brown fox' AS text")
    kept = d.keep_clean(docs, bench)
    assert kept.schema == docs.schema
    assert rows(kept) == rows(docs.where("text IS NULL OR NOT text LIKE '%fox%'"))


def test_removed_spans(spark):
    docs = spark.createDataFrame([(1, ">> The Quick, brown fox! Runs."), (2, "clean text"), (3, None)], "doc_id LONG, text STRING")
    bench = spark.sql("SELECT 1L AS item_id, 'quick brown fox' AS text")
    cleaned = dict(rows(d.remove_spans(docs, d.contamination(docs, bench))))
    assert cleaned == {1: ">> The Runs.", 2: "clean text", 3: None}


@pytest.mark.parametrize("automaton_words", [d.AUTOMATON_WORDS, 4])
def test_cut_texts(spark, automaton_words):
    """Row by row, whatever the ids: texts over the limit go, shorter spans than asked for stay, other columns and nulls stay."""
    long = " ".join(f"w{i}" for i in range(60))
    texts = [(1, f">> The Quick, brown fox! {long}"), (1, f"{long} QUICK BROWN FOX"), (None, f"{long}. quick-brown_fox, end"), (2, "quick brown fox"), (3, "clean Text!"),
             (4, None), (5, ""), (6, f"{long} one two {long}"), (6, f"{long} one two {long}")]
    docs = spark.createDataFrame([(i, t, "mine", [1, 2], "u") for i, t in texts], "doc_id LONG, text STRING, spans STRING, `a.b` ARRAY<INT>, _doc STRING")
    bench = spark.sql("SELECT 1L AS item_id, 'quick brown fox' AS text UNION ALL SELECT 2L, 'one two'")
    cut = d.clean_texts(docs, bench, percent=6, automaton_words=automaton_words)
    assert cut.schema == docs.schema
    want = [f">> The {long}", f"{long} ", f"{long}. end", "clean Text!", None, "", f"{long} {long}", f"{long} {long}"]
    assert sorted(map(repr, (r.text for r in cut.collect()))) == sorted(map(repr, want))
    assert all((r.spans, r["a.b"], r._doc) == ("mine", [1, 2], "u") for r in cut.collect())
    longer = d.clean_texts(docs, bench, percent=6, span_words=3, automaton_words=automaton_words)
    assert sorted(map(repr, (r.text for r in longer.collect()))) == sorted(map(repr, [*want[:6], *[f"{long} one two {long}"] * 2]))
    none = d.clean_texts(docs, bench, percent=6, span_words=4, automaton_words=automaton_words)
    assert rows(none) == rows(d.keep_clean(docs, bench, percent=6)) and none.count() == 8
    assert d.clean_texts(docs.where("false"), bench).collect() == []
    assert rows(d.clean_texts(docs, bench.where("false"))) == rows(docs)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: tuple(r) for r in QUERIES["op6_decontaminate"](spark, SF).collect()}
    for r in docs:
        n, hit, names = brute(r.text, items)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert got[r.doc_id] == (r.doc_id, n, hit, len(names), digest, hit > 0 and 20 * hit >= n)


def test_large_benchmark_in_bounded_shards(spark, monkeypatch):
    """No more than one shard of bounded size is broadcast at a time; long items are cut, results are whole."""
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    items = [(i, text(rng.randint(1, 60))) for i in range(40)] + [(99, text(700))]
    long = items[-1][1].split()
    docs = [(i, text(rng.randint(0, 300))) for i in range(40)] + [(50, " ".join(long[80:120])), (51, items[-1][1]), (51, items[-1][1]), (None, items[3][1]), (52, None)]
    docs += [(100 + i, items[5][1]) for i in range(30)]
    bench, frame = spark.createDataFrame(items, "item_id LONG, text STRING"), spark.createDataFrame(docs, "doc_id LONG, text STRING")
    held, most, send = {}, [], type(spark.sparkContext).broadcast

    def broadcast(self, value):
        sent = send(self, value)
        held[id(sent)] = sum(len(words(t)) for _, t in value[1])
        most.append(sum(held.values()))
        destroy = sent.destroy
        sent.destroy = lambda *a, **k: (held.pop(id(sent)), destroy(*a, **k))
        return sent

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    found = d.contamination(frame, bench, window=6, automaton_words=300).collect()
    got = sorted(((r.id, r.n_words, sum(s.end - s.start for s in r.spans), list(r["items"])) for r in found), key=repr)
    counts = [(i, t, *brute(t, items, 6)) for i, t in docs]
    assert got == sorted(((i, *n) for i, _, *n in counts), key=repr)
    other = frame.selectExpr("*", "'mine' AS _salt", "'mine' AS _mark", "'mine' AS text2")
    kept = d.keep_clean(other, bench, window=6, automaton_words=300, percent=30)
    assert kept.schema == other.schema
    want = [(i, t, "mine", "mine", "mine") for i, t, n, hit, _ in counts if not hit or 100 * hit < 30 * n]
    assert rows(kept) == sorted(want, key=repr) and 0 < len(want) < len(docs)
    assert len(most) > 10 and max(most) <= 300 and not held
