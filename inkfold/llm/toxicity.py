"""Toxicity by a factorization machine over hashed terms.

Terms are words, the beginnings of longer words, the second occurrence of either in a text, and the text's length as a power
of two. Each has a weight and a small vector; the product of two vectors adds to the score of a text with both terms,
so that terms which mean little alone (a beginning that also occurs by chance in long texts) count together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.llm.common import bounded_sample, filter_batches, map_batches

#: Terms are hashed to so many numbers, first and second occurrences each to half of them.
HASH_BITS = 19
#: Terms that the machine uses: those whose occurrence goes most with the label, by chi-square.
TERMS = 1500
#: Labelled documents that it is fitted on, chosen by hash of the id. A bounded sample.
LABELLED = 20_000
#: Documents that a term occurs in at least, among those.
LEAST_DOCUMENTS = 4
FACTORS = 6
EPOCHS = 30
BEGINNINGS = (4, 5, 6, 7)
_LENGTHS = 24
_KEPT_WORDS = 300_000
_SEPARATE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_HALF = 1 << (HASH_BITS - 1)


def _hash(term: bytes) -> int:
    return zlib.crc32(term) & (_HALF - 1)


def _word_terms(word: bytes) -> bytes:
    """A word's terms as int32 bytes: itself, and its beginnings if it is longer."""
    letters = word.decode("utf-8", "replace")
    own = [_hash(b"w" + word), *(_hash(b"b" + letters[:n].encode()) for n in BEGINNINGS if len(letters) > n)]
    return np.array(own, np.int32).tobytes()


_WORD_TERMS: dict[bytes, bytes] = {}


def text_terms(text: str | None) -> tuple[np.ndarray, int]:
    """The hashed terms of a text, repeats included, and its number of words."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_SEPARATE).split()
    if len(_WORD_TERMS) > _KEPT_WORDS:
        _WORD_TERMS.clear()
    known, made = _WORD_TERMS.get, []
    for w in words:
        own = known(w)
        if own is None:
            own = _WORD_TERMS[w] = _word_terms(w)
        made.append(own)
    return np.frombuffer(b"".join(made), np.int32), len(words)


def present(terms: np.ndarray) -> np.ndarray:
    """Each term once; a term that occurs again also as that of its second occurrence."""
    once, n = np.unique(terms, return_counts=True)
    return np.concatenate((once, once[n > 1] + _HALF))


@dataclass
class Machine:
    """place: hashed term -> row of the weights, or -1. The rows after the terms are those of lengths."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def active(self, text: str | None) -> np.ndarray:
        terms, n = text_terms(text)
        used = (self.place[terms] >= 0) | (self.place[terms + _HALF] >= 0)
        rows = self.place[present(terms[used])]
        return np.append(rows[rows >= 0], len(self.weights) - _LENGTHS + min(n.bit_length(), _LENGTHS - 1)).astype(np.int32)

    def margins(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of texts whose active rows stand one after the other, from starts on; no text is without one."""
        v = self.factors[rows]
        total = np.add.reduceat(v, starts)
        squares = np.add.reduceat(v * v, starts)
        return self.bias + np.add.reduceat(self.weights[rows], starts) + 0.5 * (total * total - squares).sum(1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(texts: list[np.ndarray], labels: np.ndarray, place: np.ndarray, n_terms: int, seed: int = 7) -> Machine:
    """Logistic loss, AdaGrad on small batches, weight decay on what a batch touches. texts: active rows of each."""
    random = np.random.default_rng(seed)
    size = n_terms + _LENGTHS
    share = np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3)
    machine = Machine(place, float(np.log(share / (1 - share))), np.zeros(size), random.normal(0, 0.02, (size, FACTORS)))
    seen_w, seen_v, seen_b = np.full(size, 0.1), np.full((size, FACTORS), 0.1), 0.1
    sizes = np.array([len(x) for x in texts])
    for epoch in range(EPOCHS if len(set(labels.tolist())) > 1 else 0):
        rate = 0.1 if epoch < EPOCHS * 2 // 3 else 0.03
        order = random.permutation(len(texts))
        for at in range(0, len(order), 128):
            chosen = order[at : at + 128]
            rows = np.concatenate([texts[i] for i in chosen])
            starts = np.concatenate(([0], np.cumsum(sizes[chosen])[:-1]))
            v = machine.factors[rows]
            total = np.add.reduceat(v, starts)
            margin = machine.bias + np.add.reduceat(machine.weights[rows], starts) + 0.5 * (total * total - np.add.reduceat(v * v, starts)).sum(1)
            slope = (_sigmoid(margin) - labels[chosen]) / len(chosen)
            each = np.repeat(slope, sizes[chosen])
            step = np.bincount(rows, each, size)
            pull = np.zeros((size, FACTORS))
            np.add.at(pull, rows, each[:, None] * (np.repeat(total, sizes[chosen], axis=0) - v))
            touched = np.unique(rows)
            step[touched] += 2e-5 * machine.weights[touched]
            pull[touched] += 1e-4 * machine.factors[touched]
            seen_w += step * step
            seen_v += pull * pull
            seen_b += slope.sum() ** 2
            machine.weights -= rate * step / np.sqrt(seen_w + 1e-12)
            machine.factors -= rate * pull / np.sqrt(seen_v + 1e-12)
            machine.bias -= rate * slope.sum() / np.sqrt(seen_b)
    return machine


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves no remainder by 5. A null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Machine:
    """A machine from the labelled rows that are not held out; of several labels of an id the largest counts.

    Without labels of both kinds it knows nothing and gives every text the share of the label (or 0.001).
    """
    session = docs.sparkSession
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    known = bounded_sample(known, ["id"], LABELLED)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = rows.join(F.broadcast(known), "id").select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 2 * _HALF), np.int32)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[min(max(label, 0), 1), present(text_terms(text.as_py())[0])] += 1
        at = np.flatnonzero(seen.any(0)).astype(np.int32)
        yield pa.record_batch([pa.array(at), pa.array(seen[1, at]), pa.array(seen[0, at])], ["term", "bad", "good"])

    sizes = {int(r["label"] > 0): r["n"] for r in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    place, n_terms = np.full(2 * _HALF, -1, np.int32), 0
    if bad and good:
        counts = sample.mapInArrow(count, "term int, bad int, good int").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        n, a, b = F.lit(float(bad + good)), F.col("bad").cast("double"), F.col("good").cast("double")
        off = a * good - b * bad
        chi = n * off * off / ((a + b) * (n - a - b + 1) * bad * good)
        best = counts.where(F.col("bad") + F.col("good") >= LEAST_DOCUMENTS).orderBy(chi.desc(), "term").limit(TERMS)
        chosen = [r[0] for r in best.select("term").collect()]
        place[chosen] = np.arange(len(chosen))
        n_terms = len(chosen)
    empty = Machine(place, 0.0, np.zeros(n_terms + _LENGTHS), np.zeros((n_terms + _LENGTHS, FACTORS)))
    shared = session.sparkContext.broadcast(empty)

    def rows_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [shared.value.active(text.as_py()).tolist() for text in batch.column(0)]
        return pa.record_batch([pa.array(made, pa.list_(pa.int32())), batch.column(1)], ["rows", "label"])

    got = map_batches(sample, rows_of, "rows array<int>, label int").collect()
    got.sort(key=lambda r: (r["label"], r["rows"]))  # whatever order the tasks end in
    shared.destroy()
    return fit([np.array(r["rows"], np.int32) for r in got], np.array([float(r["label"] > 0) for r in got]), place, n_terms)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, score from 0 to 1) per row of docs. Null and empty texts have a score too, that of no terms.

    Repeated rows stay repeated; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([rows.column(0), pa.array(_scores(shared.value, rows.column(1)))], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, batch, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, machine: Machine, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they are, that score less than least."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return filter_batches(docs, text_col, lambda texts: _scores(shared.value, texts) < least)


def _scores(machine: Machine, texts: pa.Array) -> np.ndarray:
    active = [machine.active(text.as_py()) for text in texts]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in active])[:-1])).astype(np.int64)
    return _sigmoid(machine.margins(np.concatenate(active), starts))
