import math
import random as rand
import sys
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from inkfold.llm import gru, lm
from inkfold.llm.queries import QUERIES
from tests.llm.helpers import documents, empty

SF = "/root/testdata/sf0.001"


def words(text):
    return [*(text or "").encode().lower().split(), b""]


def base(docs, training):
    counts = Counter(w for _, t in training for w in words(t))
    n, v = sum(counts.values()), len(counts)
    score = lambda own: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
    return sorted(((str(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n, round(score(words(t)), 4)) for i, t in docs))


def got(found):
    return sorted((str(r.id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)


def test_base_scores_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN_WORDS", 4)  # most counts are joined
    docs = documents(spark)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    for condition in ("doc_id < 6", "true", "false"):
        training = docs.where(condition)
        found = lm.score(docs, training).collect()
        assert got(found) == base(pairs, [(r.doc_id, r.text) for r in training.collect()])
        assert all(np.isfinite(r.score) and r.score <= 1e-9 for r in found)
    assert lm.score(empty(spark), docs).collect() == []


def test_probabilities_add_up_to_one():
    """Over all ids at each step, whatever came before; and carried state: cutting the windows elsewhere changes nothing."""
    weights = gru.initial(np.random.default_rng(0).integers(1, 50, gru.START))
    for k in ("classes", "words", "input"):
        weights[k] = weights[k] * 4
    before = np.random.default_rng(1).integers(0, gru.START, 55)
    whole = gru.log_probabilities(weights, [np.append(before, y).astype(np.int16) for y in range(gru.START)])
    prefix = gru.log_probabilities(weights, [before.astype(np.int16)])[0]
    assert np.isclose(np.sum(10.0 ** (whole - prefix)), 1, atol=1e-3)
    text = [np.random.default_rng(2).integers(0, gru.START, 130).astype(np.int16)]
    long = gru.log_probabilities(weights, text)
    window, gru.WINDOW = gru.WINDOW, 7
    try:
        assert np.allclose(gru.log_probabilities(weights, text), long, rtol=1e-5)
    finally:
        gru.WINDOW = window
    mixed = gru.log_probabilities(weights, [text[0][:9], text[0], text[0][:40]])
    assert np.allclose(mixed[1], long[0], rtol=1e-5)


def test_slopes():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, gru.START, n).astype(np.int16) for n in (3, 12, 7)]
    weights = gru.initial()
    trainer = gru.Trainer(weights, 0.1)
    held = {}
    trainer._move = lambda g, part: held.update(g)
    trainer.learn(texts)
    total = sum(map(len, texts))
    for k, g in held.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        both = []
        for step in (1e-2, -1e-2):
            moved = {n: v.copy() for n, v in weights.items()}
            moved[k][at] += step
            both.append(-gru._score(moved, texts).sum() / total)
        assert np.isclose(g[at], (both[0] - both[1]) / 2e-2, rtol=0.05), k


def test_query_beats_the_base(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op5_language_model"](spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    want = base(docs, [d for d in docs if not out(d[0])])
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == want
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in docs if out(i)}
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.97


def test_counts_follow_the_corpus(spark):
    docs = documents(spark).where("doc_id < 8")
    twice = docs.union(docs)
    once = {r.word: r.n for r in lm.word_counts(docs).collect()}
    assert {r.word: r.n for r in lm.word_counts(twice).collect()} == {w: 2 * n for w, n in once.items()}
    assert lm.word_counts(docs).agg(F.sum("n")).first()[0] == sum(len(words(r.text)) for r in docs.collect())


def test_long_text_beside_short_ones():
    """Lanes take memory by tokens, not by lanes times the longest text; scores and training stay whole."""
    random = np.random.default_rng(3)
    texts = [random.integers(0, gru.START, n).astype(np.int16) for n in (40_000, *[7] * 511)]
    weights = gru.initial()
    tracemalloc.start()
    scores = gru.log_probabilities(weights, texts)
    trainer = gru.Trainer(weights, 0.004)
    trainer.learn(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000_000 and trainer.tokens == sum(map(len, texts))
    alone = [gru.log_probabilities(weights, [t])[0] for t in (texts[0], texts[1], texts[-1])]
    assert np.allclose(alone, [scores[0], scores[1], scores[-1]], rtol=1e-5)


def test_words_of_odd_texts():
    """White space is the ASCII six, only A-Z are lowered, a batch may begin inside its buffers."""
    rng = rand.Random(4)
    odd = [None, "", "  ", " a ", "A\x0bB\x1cÀ É x\x85y\n", "a\x00b c", *("".join(rng.choice("aB \t\n\x0b\x0c\r\x1c\x1f\x85\xa0é中") for _ in range(rng.randint(0, 30))) for _ in range(500))]
    for texts in (odd, odd[:1], []):
        found, at, sizes = lm.cut_words(pa.array(["not this", *texts], pa.string())[1:])
        assert [found[i].as_py() for i in at.tolist()] == [w for t in texts for w in words(t)[:-1]]
        assert sizes.tolist() == [len(words(t)) - 1 for t in texts]


def calls(work):
    """Calls of functions, built-in ones included, that work makes."""
    n = 0

    def count(_frame, event, _arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        work()
    finally:
        sys.setprofile(None)
    return n


def test_work_is_by_batch_and_window():
    """Words are looked up once a batch, not once a token; a window takes few calls, whatever the number of classes in it."""
    texts = pa.array([" ".join(f"w{i % 90}" for i in range(1000))] * 40)
    known = lm.Vocabulary({b"w1": 0, b"": 1}, np.array([1, 0, 0], np.int16), np.zeros(3), np.zeros(gru.GROUPS), np.ones(gru.START), 9, 3)
    assert calls(lambda: known.encode(texts)) < 1000
    rng = np.random.default_rng(5)
    ids = [rng.integers(0, gru.START, 200).astype(np.int16) for _ in range(64)]
    assert calls(lambda: gru.log_probabilities(gru.initial(), ids)) < 3500
    assert calls(lambda: gru.Trainer(gru.initial(), 0.004).learn(ids)) < 5500
