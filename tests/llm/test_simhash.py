import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from inkfold.llm import common, simhash
from inkfold.llm.common import connected
from inkfold.llm.queries import QUERIES
from tests.llm.helpers import SF, documents, empty, rows


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def components(values):
    """Brute force over {id: fingerprint}."""
    own = {i: i for i in values}
    ids = sorted(values)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if own[a] < own[b] and bin(values[a] ^ values[b]).count("1") <= 4:
                    own[b], changed = own[a], True
    return own


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_texts_of_all_kinds(spark):
    docs = documents(spark)
    got = rows(simhash.near_duplicates(docs))
    want = {r.doc_id: fingerprint(r.text) for r in docs.collect() if r.doc_id is not None}
    own = components(want)
    expected = [(i, signed(fp), own[i]) for i, fp in want.items()] + [(3, signed(want[3]), own[3]), (None, signed(fingerprint("no id")), None)]
    assert got == sorted(expected, key=repr)
    assert own[0] == own[1] == own[2] == 0 and own[5] == 4


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []


def family(rng, n, spread):
    center = rng.getrandbits(64)
    out = []
    for _ in range(n):
        value = center
        for b in rng.sample(range(64), rng.randint(0, spread)):
            value ^= 1 << b
        out.append(value)
    return out


@pytest.mark.parametrize("tile", [7, 16384])
def test_links_against_brute_force(spark, tile):
    """Families of near fingerprints of several sizes, some larger than a tile and larger than a small group."""
    rng = random.Random(4)
    values = [v for n, spread in [(90, 3), (30, 6), (20, 2), (5, 8)] for v in family(rng, n, spread)] + [rng.getrandbits(64) for _ in range(80)]
    values = dict(enumerate(dict.fromkeys(values)))
    frame = spark.createDataFrame([(signed(v), i) for i, v in values.items()], "fp LONG, id LONG")
    sample = np.array(list(values.values()), np.uint64)
    for plan in (simhash.make_plan(sample, len(values), 4), [(list(range(16)), 1), *[(list(range(16 * k, 16 * k + 16)), 0) for k in (1, 2, 3)]]):
        links = simhash.bucket_links(simhash.bucket_entries(frame, plan), 4, tile)
        found = dict(rows(connected(links)))
        want = components(values)
        assert {i: found.get(i, i) for i in values} == want


def test_thresholds_add_up():
    rng = np.random.default_rng(0)
    sample = rng.integers(0, 2**63, 500).astype(np.uint64)
    for n in (500, 10**6, 10**9):
        plan = simhash.make_plan(sample, n, 4)
        bits = sorted(b for part, _ in plan for b in part)
        assert len(set(bits)) == len(bits)
        # the generalised principle: with the parts left out (-1), thresholds add up to tau - m + 1
        assert any(sum(t for _, t in plan) - (m - len(plan)) == 4 - m + 1 for m in range(len(plan), 6))
    assert simhash.allot([{-1: 0, 0: 5, 1: 9}, {-1: 0, 0: 1, 1: 2}], 0) == [-1, 1]


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (400, 64)).astype(float)
    bits[:, 40] = bits[:, 3]
    bits[:, 50] = bits[:, 3]
    part = next(p for p in simhash.group_bits(bits, 4) if 3 in p)
    assert {3, 40, 50} <= set(part)


def test_majority():
    rng = np.random.default_rng(2)
    groups = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 2, 255, 256, 1000, 0, 3)]
    got = simhash.majority(np.concatenate(groups), np.array([len(g) for g in groups]))
    for g, value in zip(groups, got.tolist()):
        assert value == sum((sum(int(h) >> b & 1 for h in g) * 2 > len(g)) << b for b in range(64))


def test_query(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, SF).collect()}
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    values = {i: fingerprint(t) for i, t in texts.items()}
    own = components(values)
    assert got == {i: (f"{v:016x}", own[i]) for i, v in values.items()}


def test_chains_and_hubs(spark):
    chain = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    hub = spark.range(100, 400).select(F.lit(1000).cast("long").alias("a"), F.col("id").alias("b"))
    found = dict(rows(connected(chain.union(hub).union(spark.sql("SELECT 7777L, 7777L")))))
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 100 for i in [*range(100, 400), 1000]) and found[7777] == 7777
    assert connected(chain.where("false")).collect() == []


def test_hubs_are_dealt_over_tasks(spark, monkeypatch):
    """A third of all edges on one id: its edges are salted, and the components are the same."""
    asked = []
    real = common.salted_join
    monkeypatch.setattr(common, "salted_join", lambda left, right, key, hot, salt, **o: asked.append(hot) or real(left, right, key, hot, salt, **o))
    edges = [(10_000 + i, 5) for i in range(2000)] + [(20_000 + i, 20_000 + i - i % 7) for i in range(4000)]
    found = dict(rows(connected(spark.createDataFrame(edges, "a LONG, b LONG"))))
    assert found == {**{a: 5 for a, b in edges if b == 5}, 5: 5, **{a: b for a, b in edges if b != 5}}
    assert any(5 in hot for hot in asked)
