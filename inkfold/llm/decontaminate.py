"""Benchmark decontamination with a generalised suffix automaton over words.

The benchmark is cut into shards of bounded size. The items of one shard at a time are broadcast, and each Python worker
builds their automaton. A task streams the words of each document through it and keeps the length of the longest match that
ends at each word. A match of at least `window` words means
that the window ending there occurs in an item; the state on the suffix path that holds the string of exactly that
length names the items. An item shorter than a window counts as one window of its own length.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from inkfold.llm.common import cut, filter_batches, fresh_path, hot_keys, map_batches, salted_join

WINDOW = 13
#: Words of benchmark text in one automaton. A larger benchmark is cut into several shards. The documents are read once for
#: each, and only one shard is broadcast or held by a worker at a time.
AUTOMATON_WORDS = 200_000

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SPANS = "array<struct<start:int,end:int>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case; runs of a-z, 0-9 and characters past ASCII, as UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(_WORDS).split(b" ") if text else []


def clean_words(text: str | None) -> list[bytes]:
    return [w for w in words_of(text) if w]


@dataclass
class Automaton:
    """next: word -> state by state; length: of the longest string; link: the state of the longest shorter suffix.

    items: state of a window -> the ids of the items that hold it. short: state -> (words, ids) of the short items that are a
    suffix of its strings.
    """

    window: int
    next: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    items: dict[int, set[str]] = field(default_factory=lambda: defaultdict(set))
    short: dict[int, list[tuple[int, frozenset[str]]]] = field(default_factory=dict)

    def add(self, words: list[bytes]) -> None:
        """One more item's text; the walk starts again at the empty string."""
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def name(self, items: list[tuple[str, list[bytes]]]) -> None:
        """Notes which items each window belongs to, once all texts are in."""
        ends = defaultdict(set)
        for item, words in items:
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= self.window:
                    while self.length[self.link[state]] >= self.window:
                        state = self.link[state]
                    self.items[state].add(item)
            if 0 < len(words) < self.window:
                ends[state, len(words)].add(item)
        held = defaultdict(list)
        for (state, n), names in ends.items():
            held[state].append((n, frozenset(names)))
        if held:
            for state in range(1, len(self.next)):
                found, s = [], state
                while s > 0:
                    found += held.get(s, ())
                    s = self.link[s]
                if found:
                    self.short[state] = sorted(found, key=lambda x: -x[0])

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [start, end) of the words inside windows, in order and apart; the items whose windows occur, those without id left out."""
        follow, length, link, window, short = self.next, self.length, self.link, self.window, self.short
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        state = matched = 0
        root = follow[0]
        here = root
        for i, w in enumerate(words):
            to = here.get(w)
            if to is None:
                if not state:
                    continue
                while True:
                    state = link[state]
                    if state < 0:
                        break
                    to = follow[state].get(w)
                    if to is not None:
                        break
                if to is None:
                    state = matched = 0
                    here = root
                    continue
                matched = length[state]
            state = to
            here = follow[to]
            matched += 1
            if matched >= window:
                while length[link[state]] >= window:  # the rest of the match is no more of use
                    state = link[state]
                here = follow[state]
                matched = min(matched, length[state])
                found |= self.items[state]
                _cover(spans, i + 1 - window, i + 1)
            if short and state in short:
                for n, names in short[state]:
                    if n <= matched:
                        found |= names
                        _cover(spans, i + 1 - n, i + 1)
        found.discard(None)
        return spans, found


def _cover(spans: list[tuple[int, int]], start: int, end: int) -> None:
    while spans and spans[-1][1] >= start:
        before = spans.pop()
        start, end = min(start, before[0]), max(end, before[1])
    spans.append((start, end))


def build_automaton(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Automaton:
    """The automaton of the items (id, text)."""
    split = [(item, words) for item, text in items if (words := clean_words(text))]
    built = Automaton(window)
    for _, words in split:
        built.add(words)
    built.name(split)
    return built


def _merged(all_spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for start, end in sorted(all_spans):
        _cover(spans, start, end)
    return spans


def _pieces(words: list[bytes], most: int, window: int) -> Iterator[list[bytes]]:
    """The words in pieces of at most `most`, each beginning with the last window - 1 words of the one before."""
    at = 0
    while True:
        yield words[at : at + most]
        if at + most >= len(words):
            break
        at += most - window + 1


def _shards(benchmark: DataFrame, item: str, text: str, window: int, most: int) -> list[DataFrame]:
    """The items in frames (item, text), each of at most `most` words; of so many that a piece can be cut, if that is more.

    A running count of words numbers the shards: by row within a task, and by the sums of the tasks before it. Only these
    sums come to the driver.
    """
    session = benchmark.sparkSession
    longest = max(most // 10, 2 * window)
    width = max(most - longest, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            made = []
            for name, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if words := clean_words(whole.as_py()):
                    for piece in _pieces(words, longest, window):
                        made.append((part, before, len(piece), name, b" ".join(piece).decode("utf-8")))
                        before += len(piece)
            if made:
                columns = zip(*made, strict=True)
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, [*[pa.int64()] * 3, *[pa.string()] * 2], strict=True)], names)

    names = ["part", "before", "n", "item", "text"]
    listed = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    path = fresh_path(session, "benchmark")
    listed.mapInArrow(run, "part long, before long, n long, item string, text string").write.parquet(path)
    pieces = session.read.parquet(path)
    sums = sorted(map(tuple, pieces.groupBy("part").agg(F.sum("n")).collect()))
    ends = list(accumulate((n for _, n in sums), initial=0))
    if ends[-1] <= most:
        return [pieces.select("item", "text")]
    starts = [(part, start) for (part, _), start in zip(sums, ends[:-1], strict=True)]
    shard = F.floor((F.col("start") + F.col("before")) / width).cast("int").alias("shard")
    numbered = pieces.join(F.broadcast(session.createDataFrame(starts, "part long, start long")), "part").select(shard, "item", "text")
    path = fresh_path(session, "shards")
    numbered.write.partitionBy("shard").parquet(path)
    numbers = [r[0] for r in session.read.parquet(path).select("shard").distinct().orderBy("shard").collect()]
    return [session.read.schema("item string, text string").parquet(f"{path}/shard={k}") for k in numbers]


#: The last automaton that this worker built, by what it was built from.
_built: dict[tuple[str, int], Automaton] = {}


def _automaton(shared: Broadcast, window: int) -> Automaton:
    key, items = shared.value
    if (key, window) not in _built:
        _built.clear()
        _built[key, window] = build_automaton(items, window)
    return _built[key, window]


def _share(shard: DataFrame) -> Broadcast:
    """The items of a shard under a name of their own."""
    items = sorted(((r["item"], r["text"]) for r in shard.toLocalIterator()), key=lambda x: (x[0] or "", x[1]))
    return shard.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items))


def _found_by_text(texts: DataFrame, shards: list[DataFrame], window: int) -> DataFrame:
    """One row (mark, n words, spans, items) for each text of texts (mark, text) that some shard hits. Each shard is a pass over texts."""
    session, schema = texts.sparkSession, f"mark string, n long, spans {SPANS}, items array<string>"
    path = fresh_path(session, "spans")
    for k, shard in enumerate(shards):
        shared = _share(shard)

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                marks, counts, spans, items = [], [], [], []
                for mark, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    words = clean_words(text.as_py())
                    hit, found = _automaton(shared, window).search(words)
                    if hit:
                        marks.append(mark)
                        counts.append(len(words))
                        spans.append([{"start": a, "end": b} for a, b in hit])
                        items.append(sorted(found))
                if marks:
                    made = [pa.array(marks), pa.array(counts, pa.int64()), pa.array(spans, _ARROW_SPANS), pa.array(items, pa.list_(pa.string()))]
                    yield pa.record_batch(made, ["mark", "n", "spans", "items"])

        hits = texts.mapInArrow(run, schema)
        hits.dropDuplicates(["mark"]).write.parquet(f"{path}/shard={k}")
        shared.destroy()

    def merge(rows: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"start": a, "end": b} for a, b in _merged([(x["start"], x["end"]) for x in s])] for s in rows.column(2).to_pylist()]
        return pa.record_batch([rows.column(0), rows.column(1), pa.array(spans, _ARROW_SPANS), rows.column(3)], ["mark", "n", "spans", "items"])

    every = session.read.schema(f"{schema}, shard int").parquet(path)
    joined = every.groupBy("mark").agg(
        F.max("n").alias("n"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return cut(map_batches(joined, merge, schema))


def _mark(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_mark")


def _hot_marks(marked: DataFrame) -> list:
    return hot_keys(marked.groupBy("_mark").agg(F.count(F.lit(1)).alias("n")), "_mark")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    automaton_words: int = AUTOMATON_WORDS,
) -> DataFrame:
    """One row per row of docs: id, n_words, spans of hit words [start, end), items whose windows occur, sorted as strings.

    Null or blank texts have no words, no spans and no items. Items without words have no window; an item id that is
    repeated counts once; an item without id hits like any other and is not named. Repeated documents stay repeated. Other columns are not read. A
    benchmark of over automaton_words words is cut into shards, each of which is searched by a pass of its own while the frame is built.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shards = _shards(benchmark, item_col, item_text_col, window, automaton_words)
    if len(shards) > 1:
        marked = rows.select("*", _mark("text"))
        found = _found_by_text(marked.select("_mark", "text"), shards, window).select(F.col("mark").alias("_mark"), "spans", "items")

        def count(rows: pa.RecordBatch) -> pa.RecordBatch:
            n = [len(clean_words(t.as_py())) for t in rows.column(2)]
            return pa.record_batch([rows.column(0), rows.column(1), pa.array(n, pa.int64())], ["id", "_mark", "n_words"])

        counted = map_batches(marked.select("id", "_mark", "text"), count, f"id {kind}, _mark string, n_words long")
        joined = salted_join(counted, found, "_mark", _hot_marks(marked), "id", how="left")
        return joined.select(
            "id", "n_words", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
        )
    shared = _share(shards[0])

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        counts, spans, items = [], [], []
        for text in rows.column(1):
            words = clean_words(text.as_py())
            hit, found = _automaton(shared, window).search(words)
            counts.append(len(words))
            spans.append([{"start": a, "end": b} for a, b in hit])
            items.append(sorted(found))
        types = [pa.int64(), _ARROW_SPANS, pa.list_(pa.string())]
        made = [pa.array(x, t) for x, t in zip((counts, spans, items), types, strict=True)]
        return pa.record_batch([rows.column(0), *made], ["id", "n_words", "spans", "items"])

    return map_batches(rows, batch, f"id {kind}, n_words long, spans {SPANS}, items array<string>")


def hit_words() -> F.Column:
    """How many words the spans of contamination() cover."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(percent: int = 5) -> F.Column:
    """Some word is hit, and at least so many percent of the words."""
    return (hit_words() > 0) & (100 * hit_words() >= percent * F.col("n_words"))


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    percent: int = 5,
    automaton_words: int = AUTOMATON_WORDS,
) -> DataFrame:
    """The rows of docs, all columns as they are, that is_contaminated() would not find so.

    Of a benchmark of several shards, as in contamination(), the marks of contaminated texts are joined.
    """
    shards = _shards(benchmark, item_col, item_text_col, window, automaton_words)
    if len(shards) > 1:
        value = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
        marked = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("_doc"), _mark(text_col), F.xxhash64(*value).alias("_deal"))
        texts = docs.select(_mark(text_col), F.col(text_col).cast("string").alias("text"))
        found = _found_by_text(texts, shards, window)
        dirty = found.where((hit_words() > 0) & (100 * hit_words() >= percent * F.col("n"))).select(F.col("mark").alias("_mark"))
        return salted_join(marked, dirty, "_mark", _hot_marks(texts), "_deal", how="left_anti").select("_doc.*")
    shared = _share(shards[0])

    def clean(text: str | None) -> bool:
        words = clean_words(text)
        n = sum(end - start for start, end in _automaton(shared, window).search(words)[0])
        return not n or 100 * n < percent * len(words)

    return filter_batches(docs, text_col, lambda texts: [clean(t.as_py()) for t in texts])


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words in spans and what stands after each of them; what stands before the first word stays."""
    runs = F.regexp_extract_all(text, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]|[A-Z])+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    lead = F.regexp_extract(text, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    kept = F.filter(runs, lambda w, i: ~F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"])))
    return F.concat(lead, F.array_join(kept, ""))


def remove_spans(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the spans of contamination() cut out of the text; whole words and what stands between them go.

    found has one row per id. Documents without spans stay as they are.
    """
    spans = found.where(F.size("spans") > 0).select(F.col("id").alias(id_col), F.col("spans").alias("_spans"))
    cleaned = F.when(F.col("_spans").isNull(), F.col(text_col)).otherwise(without_spans(F.col(text_col), F.col("_spans")))
    return docs.join(spans, id_col, "left").withColumn(text_col, cleaned).drop("_spans")


def clean_texts(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    percent: int = 5,
    span_words: int = 1,
    automaton_words: int = AUTOMATON_WORDS,
) -> DataFrame:
    """The rows of docs that keep_clean() keeps, with their spans of at least span_words hit words cut out of the text.

    Works row by row: ids are not read, so rows with a null or repeated id are judged and cut by their own texts. All other
    columns and rows without such spans stay as they are, nulls included. span_words over the longest span cuts nothing out.
    """
    shards = _shards(benchmark, item_col, item_text_col, window, automaton_words)
    whole = F.struct(*(f"`{c}`" for c in docs.columns)).alias("_doc")
    if len(shards) > 1:
        value = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
        marked = docs.select(whole, _mark(text_col), F.xxhash64(*value).alias("_deal"))
        texts = docs.select(_mark(text_col), F.col(text_col).cast("string").alias("text"))
        found = _found_by_text(texts, shards, window).select(F.col("mark").alias("_mark"), F.col("n").alias("n_words"), "spans")
        located = salted_join(marked, found, "_mark", _hot_marks(texts), "_deal", how="left").select("_doc", "n_words", "spans")
    else:
        shared, at = _share(shards[0]), docs.columns.index(text_col)

        def locate(rows: pa.RecordBatch) -> pa.RecordBatch:
            counts, spans = [], []
            for text in rows.column(0).field(at):
                words = clean_words(text.as_py())
                hit = _automaton(shared, window).search(words)[0]
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in hit] or None)
            return pa.record_batch([rows.column(0), pa.array(counts, pa.int64()), pa.array(spans, _ARROW_SPANS)], ["_doc", "n_words", "spans"])

        rows = docs.select(whole)
        span = ArrayType(StructType().add("start", "integer").add("end", "integer"))
        located = map_batches(rows, locate, StructType([rows.schema["_doc"]]).add("n_words", "long").add("spans", span))
    kept = located.where(F.col("spans").isNull() | ~F.coalesce(is_contaminated(percent), F.lit(False)))
    long = F.filter("spans", lambda s: s["end"] - s["start"] >= span_words)
    text = F.col("_doc").getField(text_col)
    cleaned = F.when(F.size(long) > 0, without_spans(text, long)).otherwise(text).alias(text_col)
    return kept.select(*(cleaned if c == text_col else F.col("_doc").getField(c).alias(c) for c in docs.columns))
