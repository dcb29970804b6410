import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from inkfold.llm import mixing
from inkfold.llm.queries import ORACLE, QUERIES
from tests.check_oracle import connect, rows_of

SF = "/root/testdata/sf0.01"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Deal the budget out by weight; stop those above their most, share their excess among the rest, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, stopped = share * sum(sizes.values()), set()
    while True:
        left = [s for s in order if s not in stopped]
        level = (budget - sum(most * sizes[s] for s in stopped)) / (sum(weight[s] for s in left) or 1)
        over = [s for s in left if level * weight[s] > most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in stopped else level * weight[s] for s in order}
        stopped |= set(over)


def frame(spark, rows):
    extra = [f"'mine' AS {c}" for c in ("id", "size", "target", "taken", "start", "_key", "_range", "epochs")]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING").selectExpr("*", *extra)


def check(rows, made, weights=(5, 2, 1), share=1.5):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
    want = brute_targets(sizes, weights, share)
    assert sorted((r.id is None, r.id or 0, r.source or "", r.size) for r in made) == sorted((i is None, i or 0, s or "", size(t)) for i, t, s in rows)
    by_source = defaultdict(int)
    for r in made:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12, abs=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        by_source[r.source] += r.taken
    for s, t in by_source.items():
        assert t == int(want[s] + 1e-9), s


def rows_of_sources(counts):
    return [(100 * j + i, " ".join(["w"] * ((7 * i + j) % 23)), s) for j, (s, n) in enumerate(counts.items()) for i in range(n)]


@pytest.mark.parametrize("counts", [{"a": 50}, {"a": 5, "b": 60, None: 20, "Z": 3, "é": 40, "": 9}, {f"s{i:02d}": 1 + i % 7 for i in range(40)}])
def test_takes_each_target_exactly(spark, counts):
    rows = rows_of_sources(counts)
    made = mixing.mix(frame(spark, rows)).collect()
    check(rows, made)


def test_hot_source_repeated_rows_nulls(spark, monkeypatch):
    """A third of all rows is one row; null ids, null, empty and long texts; by broadcast and by salted shuffles."""
    rows = [(1, "same row again", "a")] * 60 + [(None, "no id", "a")] * 7 + [(2, None, "b"), (3, "", "c"), (4, " \t", None), (5, "w " * 5000, "d")]
    rows += [(10 + i, "x y " * i, f"s{i % 5}") for i in range(100)]
    check(rows, mixing.mix(frame(spark, rows)).collect())
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    check(rows, mixing.mix(frame(spark, rows)).collect())


def test_no_task_holds_the_hot_source(spark, monkeypatch, tmp_path):
    """Ranges cut a source, and even alike rows."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 100)
    rows = [(1, "same row", "a")] * 1500 + [(i, "x", "b") for i in range(500)]
    sized = mixing._sized(frame(spark, rows), "doc_id", "text", "source", 0)
    kept = []
    monkeypatch.setattr(mixing, "fresh_path", lambda session, what: kept.append(f"{tmp_path}/{what}") or kept[-1])
    mixing.running_totals(sized, "source", mixing.ORDER, {"start": "size"}, len(rows)).count()
    ranges = spark.read.parquet(f"{tmp_path}/ranges").groupBy("_range").count().collect()
    assert sum(r["count"] for r in ranges) == 2000 and max(r["count"] for r in ranges) < 400


@pytest.mark.parametrize("rows", [[], [(1, "", "a"), (2, None, None)]])
def test_no_words(spark, rows):
    made = mixing.mix(frame(spark, rows)).collect()
    assert len(made) == len(rows) and all(r.taken == 0 and r.target == 0 and r.size == 0 for r in made)
    assert mixing.mixture(frame(spark, rows)).collect() == []


def test_reruns_agree_and_seeds_differ(spark):
    rows = rows_of_sources({"a": 90, "b": 10})
    once = sorted(map(tuple, mixing.mix(frame(spark, rows)).collect()))
    assert once == sorted(map(tuple, mixing.mix(frame(spark, rows[::-1]).repartition(7)).collect()))
    assert once != sorted(map(tuple, mixing.mix(frame(spark, rows), seed=1).collect()))


def test_mixture_holds_the_words_taken(spark):
    rows = [(i, " ".join(f"w{i}.{j}" for j in range(i % 17)), "ab"[i % 7 == 0]) for i in range(200)] + [(7, "same one", None)] * 9
    docs = frame(spark, rows)
    for epochs, options in ((2, {}), (1, {"weights": [1, 9, 3], "share": 0.3, "seed": 4})):
        taken, by_id = mixing.mix(docs, **options).collect(), defaultdict(int)
        for r in taken:
            by_id[r.id, r.source] += r.taken
        made = mixing.mixture(docs, **options).collect()
        for r in made:
            whole = [t for i, t, s in rows if (i, s) == (r.id, r.source)][0].split()
            assert size(r.text) == r.words > 0 and r.text.split() == whole[: r.words]
            by_id[r.id, r.source] -= r.words
        assert not any(by_id.values()) and max(r.epoch for r in made) == epochs
        cut = [r for r in made if r.words < [size(t) for i, t, s in rows if (i, s) == (r.id, r.source)][0]]
        assert len(cut) <= 3


def test_native_and_narrow(spark, plan_of):
    """No Python worker, and texts are only read to be counted and hashed."""
    plan = plan_of(mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")))
    assert "Python" not in plan and "Arrow" not in plan and "text" not in plan


def test_query(spark):
    found = QUERIES["op12_mixing"](spark, SF)
    ours = rows_of(found.columns, found.collect())
    cursor = connect(SF).execute(ORACLE["op12_mixing"])
    assert ours == rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert found.agg(F.sum("taken")).first()[0] > found.agg(F.sum("size")).first()[0]
