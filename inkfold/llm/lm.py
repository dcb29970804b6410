"""Language-model scores of documents: a gated recurrent network over words, beside a smoothed unigram model.

All training texts give the word counts and all of them train the network: every task trains a copy of the same first network
on its own texts, and the copies are averaged by tokens. The most frequent words are outputs of the network; other words
fall into groups by their last byte, and within a group a word has its smoothed share of the group's counts, so that the
probabilities of all words add up to one. A text is scored as a whole, its state carried from window to window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.llm import gru
from inkfold.llm.common import bounded_sample, fresh_path

#: Words whose counts are broadcast at most, the most frequent ones; the counts of all others are joined.
KNOWN_WORDS = 200_000
#: Training texts for the first network, chosen by hash of the id among those of at most so many characters. A bounded sample.
FIRST_TEXTS, FIRST_CHARS, FIRST_ROUNDS = 1200, 20_000, 3
FIRST_RATE, RATE = 0.01, 0.004
_DISTINCT = 300_000
_BUCKETS = 8  # of counts, for each power of two


def _group(word: bytes) -> int:
    return word[-1] & (gru.GROUPS - 1)


def _groups(words: pa.Array) -> np.ndarray:
    """The group of each word; -1 for the empty word."""
    words = pa.concat_arrays([words, pa.array([], words.type)])  # from the start of its buffers
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    found = np.full(len(words), -1, np.int32)
    some = np.flatnonzero(ends[1:] > ends[:-1])
    found[some] = data[ends[1:][some] - 1] & (gru.GROUPS - 1)
    return found


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts, A-Z lower-cased; of all words the numbers among those; how many words each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    found = split.flatten().dictionary_encode()
    words, at, sizes = found.dictionary.cast(pa.binary()), found.indices.to_numpy(zero_copy_only=False), pc.list_value_length(split).to_numpy(zero_copy_only=False)
    blank = pc.index(words, pa.scalar(b"", pa.binary())).as_py()  # beside white space at a text's begin and end
    if blank >= 0:
        kept = np.flatnonzero(at != blank)
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        at = at[kept]
    return words, at, sizes.astype(np.int64)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row (word, grp, n) for each distinct word of docs, the empty word standing for the ends of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            words, at, sizes = cut_words(batch.column(0))
            n = np.bincount(at, minlength=len(words))
            some = np.flatnonzero(n)
            one = pa.table({"word": words.take(pa.array(some)), "n": n[some]})
            held += [one, pa.table({"word": pa.array([b""], pa.binary()), "n": np.array([len(sizes)], np.int64)})]
            size += len(some)
            if size > 2 * _DISTINCT:
                counts = added(held)
                held, size = [counts], counts.num_rows
                if size > _DISTINCT:
                    yield rows(counts)
                    held, size = [], 0
        if held:
            yield rows(added(held))

    def added(counts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(counts).group_by("word").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

    def rows(counts: pa.Table) -> pa.RecordBatch:
        words = pa.concat_arrays(counts["word"].chunks)
        return pa.record_batch([words, pa.array(_groups(words)), pa.concat_arrays(counts["n"].chunks)], ["word", "grp", "n"])

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word binary, grp int, n long")
    return found.groupBy("word", "grp").agg(F.sum("n").alias("n"))


@dataclass
class Encoded:
    """Texts as ids for the network, each with the end, one after the other from starts on.

    at: the number of each token among words, the end being one more than those. place: by such a number the place in the vocabulary, or -1.
    """

    ids: np.ndarray
    starts: np.ndarray
    words: pa.Array
    at: np.ndarray
    place: np.ndarray
    word_ids: np.ndarray

    def texts(self) -> list[np.ndarray]:
        return np.split(self.ids, self.starts[1:]) if len(self.starts) else []


@dataclass
class Vocabulary:
    """place: word -> number in ids (of the network) and logs (log10 of the count + 1). group_logs: log10 of a group's total. id_counts: by id."""

    place: dict[bytes, int]
    ids: np.ndarray
    logs: np.ndarray
    group_logs: np.ndarray
    id_counts: np.ndarray
    tokens: int
    distinct: int

    def encode(self, texts: pa.Array) -> Encoded:
        words, at, sizes = cut_words(texts)
        find, groups = self.place.get, _groups(words)
        place = np.array([find(w, -1) for w in [*words.to_numpy(zero_copy_only=False).tolist(), b""]], np.int64)
        ids = self.ids[place]
        missing = np.flatnonzero(place[:-1] < 0)
        ids[missing] = gru.LISTED + groups[missing]
        if place[-1] < 0:
            ids[-1] = 0
        at = np.insert(at, np.cumsum(sizes), len(words))
        return Encoded(ids[at], np.cumsum(sizes + 1) - sizes - 1, words, at, place, ids)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The totals of counts (word, grp, n), and the counts of its most frequent words, at most KNOWN_WORDS of them."""
    totals = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, distinct = totals[0] or 0, totals[1]
    bucket = F.floor(F.log2("n") * _BUCKETS)
    room, least = KNOWN_WORDS, math.inf
    for b, n in sorted(((r[0], r[1]) for r in counts.groupBy(bucket.alias("b")).count().collect()), reverse=True):
        if n > room:
            break
        room, least = room - n, b
    known = counts.where(bucket >= F.lit(float(least))) if least < math.inf else counts.limit(0)
    rows = sorted(zip(*(known.select("word", "n").toArrow().column(i).to_pylist() for i in range(2)), strict=True), key=lambda r: (-r[1], r[0]))
    listed = [w for w, _ in rows if w][: gru.LISTED - 1]
    number = {w: i + 1 for i, w in enumerate(listed)}
    group_n, group_v = np.zeros(gru.GROUPS), np.zeros(gru.GROUPS)
    for r in counts.where("grp >= 0").groupBy("grp").agg(F.sum("n"), F.count(F.lit(1))).collect():
        group_n[r[0]], group_v[r[0]] = r[1], r[2]
    counted = dict(rows)
    for w in listed:
        group_n[_group(w)] -= counted[w]
        group_v[_group(w)] -= 1
    ids = np.array([0 if not w else number.get(w, gru.LISTED + _group(w)) for w, _ in rows] + [0], np.int16)
    logs = np.array([math.log10(n + 1) for _, n in rows] + [0.0])
    id_counts = np.concatenate(([counted.get(b"", 0)], [counted[w] for w in listed], np.zeros(gru.LISTED - 1 - len(listed)), group_n))
    return Vocabulary({w: i for i, (w, _) in enumerate(rows)}, ids, logs, np.log10(group_n + group_v + 1), id_counts, tokens, distinct)


def train(docs: DataFrame, words: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> dict[str, np.ndarray]:
    """The network, trained on all rows of docs once after a first network on a bounded sample of them."""
    session = docs.sparkSession
    shared = session.sparkContext.broadcast(words)
    some = bounded_sample(docs.where(F.length(text_col) <= FIRST_CHARS), [id_col], FIRST_TEXTS).select(text_col).collect()
    some.sort(key=lambda r: r[0])  # whatever order the tasks end in
    first = gru.Trainer(gru.initial(words.id_counts), FIRST_RATE)
    texts = words.encode(pa.array([r[0] for r in some], pa.string())).texts()
    for _ in range(FIRST_ROUNDS if some else 0):
        first.learn(texts, gru.FIRST_LANES)
    start = session.sparkContext.broadcast(gru.flat(first.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, held, size = gru.Trainer(gru.unflat(start.value), RATE), [], 0
        for batch in batches:
            for text in shared.value.encode(batch.column(0)).texts():
                held.append(text)
                size += len(text)
                if size >= gru.AT_ONCE:
                    trainer.learn(held)
                    held, size = [], 0
        if held:
            trainer.learn(held)
        if trainer.tokens:
            values = gru.flat(trainer.weights).astype(np.float64) * trainer.tokens
            at = np.arange(-1, len(values), dtype=np.int32)
            yield pa.record_batch([pa.array(at), pa.array(np.concatenate(([float(trainer.tokens)], values)))], ["at", "value"])

    sums = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    start.destroy()
    if not sums.num_rows:
        return first.weights
    values = np.zeros(sums.num_rows)
    values[sums["at"].to_numpy() + 1] = sums["value"].to_numpy()
    return gru.unflat(values[1:] / values[0])


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 2 by 7. A null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 7 == 2, F.lit(False))


def score(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_tokens, n_known, train_tokens, base_score, score (both log10 of a probability).

    training has the same columns. Null and empty texts have one token, the end. Repeated rows stay repeated. Without training
    rows every word is unknown. Other columns are not read. Counts of rarer words are joined by word, each text's words
    counted first; frequent words are known to the tasks, so that no word is hot in that join.
    """
    session = docs.sparkSession
    path = fresh_path(session, "words")
    word_counts(training, text_col).write.parquet(path)
    counts = session.read.parquet(path)
    words = vocabulary(counts)
    model = train(training.select(id_col, text_col), words, id_col, text_col)
    shared = session.sparkContext.broadcast((words, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = shared.value
        for batch in batches:
            if batch.num_rows:
                own = words.encode(batch.column(1))
                yield _rows(batch, own, words, gru.log_probabilities(model, own.texts()))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, mark long, word binary, k int, copies int, n_tokens long, n_known long, logs double, net double"
    parts = rows.mapInArrow(run, schema)
    joined = parts.join(counts.select("word", "n"), "word", "left")
    more = F.when(F.col("n").isNotNull(), F.col("k") * F.log10(F.col("n") + 1)).otherwise(0.0)
    found = F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0).cast("long")
    texts = joined.groupBy("id", "mark").agg(
        F.sum("copies").alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + found).alias("n_known"),
        F.sum(F.col("logs") + more).alias("logs"),
        F.sum(F.col("net") + more).alias("net"),
    )
    m = F.col("copies")
    whole = lambda c: F.expr(f"{c} div copies")
    total = math.log10(words.tokens + words.distinct + 1)
    return texts.select(
        "id",
        whole("n_tokens").alias("n_tokens"),
        whole("n_known").alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") / m - whole("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("net") / m).alias("score"),
        F.explode(F.sequence(F.lit(1).cast("long"), m)).alias("_copy"),
    ).drop("_copy")


def _rows(batch: pa.RecordBatch, own: Encoded, words: Vocabulary, network: np.ndarray) -> pa.RecordBatch:
    """A row for each text, under a word that no text has, and one for each of its rarer words."""
    names, texts = batch.column(0), pc.fill_null(batch.column(1), "").cast(pa.binary())
    mark = np.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts.to_pylist()], np.int64)
    n, n_tokens = len(mark), np.diff(own.starts, append=len(own.at))
    # by word; a place of -1 means the last log, which is zero
    known, logs = own.place >= 0, words.logs[own.place]
    grouped = own.word_ids >= gru.LISTED
    shares = np.where(grouped, logs - words.group_logs[np.where(grouped, own.word_ids.astype(np.int64) - gru.LISTED, 0)], 0.0)
    n_known, logs, shares = (np.add.reduceat(v[own.at], own.starts) for v in (known.astype(np.int64), logs, shares))
    other = np.flatnonzero(~known[own.at] & (own.at < len(own.words)))
    row = np.searchsorted(own.starts, other, "right") - 1
    pairs, k = np.unique(row * (len(own.words) + 1) + own.at[other], return_counts=True)
    row, word, t = pairs // (len(own.words) + 1), pairs % (len(own.words) + 1), len(pairs)
    alone = pa.array([b" %d %d" % (m, i) for i, m in enumerate(mark.tolist())], pa.binary())
    zeros, whole = np.zeros(t), np.zeros(t, np.int64)
    columns = [
        pa.concat_arrays([names, names.take(pa.array(row))]), pa.array(np.concatenate((mark, mark[row]))),
        pa.concat_arrays([alone, own.words.take(pa.array(word))]),
        pa.array(np.concatenate((np.zeros(n, np.int32), k.astype(np.int32)))), pa.array(np.concatenate((np.ones(n, np.int32), np.zeros(t, np.int32)))),
        pa.array(np.concatenate((n_tokens, whole)).astype(np.int64)), pa.array(np.concatenate((n_known, whole))),
        pa.array(np.concatenate((logs, zeros))), pa.array(np.concatenate((shares + network, zeros))),
    ]
    return pa.record_batch(columns, ["id", "mark", "word", "k", "copies", "n_tokens", "n_known", "logs", "net"])
