"""Periodic runs of words in documents, and texts without their repetitions.

A run is a longest stretch of words in which words q apart are the same, q being the least such period. Its zone is where the word
equals the one q later, so a run of length l has a zone of l - q words. Runs wanted here have zones of three periods or more.

Periods are searched by octave, [Q, 2Q). A document is exploded into overlapping tiles for each octave (low octaves share theirs),
of a length in proportion to Q, and every tile is solved on its own: boundaries 2Q apart cut it, and any wanted zone holds a boundary
with Q more words. The forward Z-function of a boundary says for a period how far the words after it repeat, the backward one
how far those before it do; together they give the zone. Z is evaluated for all periods of the octave at once: whether it
reaches Q by comparing block hashes, and where it does, how far it goes by bisection over hashes of prefixes. Zones are then compared
word by word, so that hashes decide nothing. A tile overlaps the next ones by more than three periods: it sees enough of a zone that
crosses its ends to tell that the zone is wanted, and gives the part it sees. Parts are shuffled by document and period and stitched.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkfold.llm.common import fresh_path

#: Runs have at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words that a tile has for itself, at least, and octaves below this one share tiles.
TILE, SHARED = 1 << 15, 10
#: A longer document's tiles are dealt over tasks; those of shorter ones are solved where the document is read.
DEALT_WORDS = 1 << 17
#: Words of documents that are solved together.
TOGETHER = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93

FRAGMENTS = "array<struct<period:long,start:long,end:long>>"
_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
RUNS = "array<struct<start:long,length:long,period:long>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def least_zone(period):
    """Words of the zone of a shortest run of the period (a number or an array)."""
    return np.maximum(LEAST_WORDS - period, (LEAST_PERIODS - 1) * period)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words: the place where a word occurs last."""
    last = dict(zip(words, range(len(words))))
    return np.fromiter(map(last.__getitem__, words), np.int64, len(words))


def tiles_of(n: int) -> Iterator[tuple[int, int, int, int]]:
    """The tiles (low octave, one past the high one, start, end) of a document of n words, for every period that a run in it can have."""
    low = 0
    while n >= max(LEAST_WORDS, LEAST_PERIODS << low):
        high = low + 1
        if low < SHARED:
            while high < SHARED and n >= LEAST_PERIODS << high:
                high += 1
        top = 1 << (high - 1)
        own, before, after = max(TILE, 16 * top), 6 * top, 8 * top
        for at in range(0, n, own):
            yield low, high, max(at - before, 0), min(at + own + after, n)
            if at + own + after >= n:
                break
        low = high


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base and of its inverse, modulo 2 to the 64."""
    inverse = pow(_BASE, -1, 1 << 64)
    made = []
    for base in (_BASE, inverse):
        powers = np.full(n, np.uint64(base))
        powers[:1] = 1
        made.append(np.cumprod(powers, dtype=np.uint64))
    return made[0], made[1]


def _least_factors(n: int) -> np.ndarray:
    """The least prime factor of each number below n."""
    found = np.arange(n)
    for p in range(2, int(n**0.5) + 1):
        if found[p] == p:
            rest = found[p * p :: p]
            rest[rest == np.arange(p * p, n, p)] = p
    return found


class _Line:
    """Tiles laid end to end, no word of one equal to any of another, with hashes of all prefixes."""

    def __init__(self, tiles: list[np.ndarray], spare: int):
        self.words = np.concatenate([*tiles, -1 - np.arange(spare)])
        self.starts = np.concatenate(([0], np.cumsum([len(t) for t in tiles]))).astype(np.int64)
        for k, (a, b) in enumerate(zip(self.starts[:-1], self.starts[1:], strict=True)):
            self.words[a:b] += k << 40
        mixed = (self.words.astype(np.uint64) + np.uint64(1)) * _MIX
        mixed ^= mixed >> np.uint64(29)
        self.powers, self.inverse = _powers(len(mixed) + 1)
        self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * self.powers[:-1], dtype=np.uint64)))

    def hashed(self, at: np.ndarray, length) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.inverse[at]

    def forward(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Z: how many words from at on equal those a period later."""
        return self._reach(at, period, len(self.words) - at - period, lambda a, n: a)

    def backward(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """The Z-function of the words before at, read backwards."""
        return self._reach(at, period, at, lambda a, n: a - n)

    def _reach(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, start: Callable) -> np.ndarray:
        low, high, width = np.zeros(len(at), np.int64), most.copy(), 1

        def equal(which: np.ndarray, length: np.ndarray) -> np.ndarray:
            a = start(at[which], length)
            same = self.hashed(a, length) == self.hashed(a + period[which], length)
            low[which[same]] = length[same]
            high[which[~same]] = length[~same] - 1
            return same

        going = np.arange(len(at))
        while len(going):  # twice as far each time, so that short ones cost few steps
            length = np.minimum(width, most[going])
            going = going[equal(going, length) & (length < most[going])]
            width *= 2
        while len(going := np.flatnonzero(low < high)):
            equal(going, (low[going] + high[going] + 1) // 2)
        return low


def _spread(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of so many places each: the range's number and the place, for every place."""
    which = np.repeat(np.arange(len(starts)), lengths)
    return which, starts[which] + np.arange(len(which)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _repeats(root: np.ndarray, factors: np.ndarray) -> bool:
    """Whether root is a shorter root repeated, by the words themselves."""
    rest = len(root)
    while rest > 1:
        shorter, rest = len(root) // int(factors[rest]), rest // int(factors[rest])
        if np.array_equal(root[shorter:], root[:-shorter]):
            return True
    return False


def _without_repeats(line: _Line, at: np.ndarray, period: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Which candidates are not repetitions of a shorter period: that would be found by itself.

    Hashes find shorter periods; of each boundary the least is compared word by word over the longest candidate.
    """
    shorter, rest = period.copy(), period.copy()
    while (rest > 1).any():
        factor = factors[rest]
        tried = period // np.maximum(factor, 1)
        todo = np.flatnonzero((rest > 1) & (shorter == period))
        same = line.hashed(at[todo], period[todo] - tried[todo]) == line.hashed(at[todo] + tried[todo], period[todo] - tried[todo])
        shorter[todo[same]] = tried[todo[same]]
        rest[todo] //= factor[todo]
        rest[shorter < period] = 1
    claimed = np.flatnonzero(shorter < period)
    if not len(claimed):
        return np.ones(len(at), bool)
    bounds, where = np.unique(at[claimed], return_inverse=True)
    least = np.full(len(bounds), np.iinfo(np.int64).max)
    np.minimum.at(least, where, shorter[claimed])
    longest = np.zeros(len(bounds), np.int64)
    np.maximum.at(longest, where, period[claimed])
    which, place = _spread(bounds, longest - least)
    sound = np.ones(len(bounds), bool)
    sound[which[line.words[place] != line.words[place + least[which]]]] = False
    keep = np.ones(len(at), bool)
    repeats = sound[where] & (period[claimed] % least[where] == 0)
    for c in claimed[~repeats].tolist():  # equal hashes of unequal words
        keep[c] = not _repeats(line.words[at[c] : at[c] + period[c]], factors)
    keep[claimed[repeats]] = False
    return keep


def solve(tiles: list[np.ndarray], low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The parts of wanted zones in tiles of word numbers, for the periods of octaves low up to high: tile, period, start, end."""
    line = _Line(tiles, 4 << (high - 1))
    size, factors = int(line.starts[-1]), _least_factors(2 << (high - 1))
    zones = []
    for octave in range(low, high):
        q = 1 << octave
        rows = -(-size // (2 * q))
        bounds = np.arange(rows) * (2 * q)
        places = (bounds[:, None] + np.arange(q, 2 * q)).ravel()
        same = line.hashed(places, q).reshape(rows, q) == line.hashed(bounds, q)[:, None]
        row, step = np.nonzero(same)
        at, period = bounds[row], step + q
        inside = at + period < size
        at, period = at[inside], period[inside]
        if not len(at):
            continue
        keep = _without_repeats(line, at, period, factors)
        at, period = at[keep], period[keep]
        start, end = at - line.backward(at, period), at + line.forward(at, period)
        long = end - start >= least_zone(period)
        zones.append(np.unique(np.column_stack((period[long], start[long], end[long])), axis=0))
    found = np.concatenate(zones) if zones else np.empty((0, 3), np.int64)
    period, start, end = found.T
    which, place = _spread(start, end - start)
    wrong = np.flatnonzero(line.words[place] != line.words[place + period[which]])
    if len(wrong):  # equal hashes of unequal words: the stretches between these words
        cut = np.unique(which[wrong])
        parts = [np.delete(found, cut, axis=0)]
        for z in cut:
            q, a, b = found[z]
            stops = np.concatenate(([a - 1], place[wrong[which[wrong] == z]], [b]))
            stretches = [(q, a + 1, b) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True) if b - a - 1 >= least_zone(q)]
            kept = [s for s in stretches if not _repeats(line.words[s[1] : s[1] + q], factors)]
            parts.append(np.array(kept, np.int64).reshape(-1, 3))
        period, start, end = np.concatenate(parts).T
    tile = np.searchsorted(line.starts, start, side="right") - 1
    return tile, period, start - line.starts[tile], end - line.starts[tile]


def _solved(documents: list[np.ndarray]) -> list[list[dict]]:
    """The fragments (period, start, end) of each document, found tile by tile."""
    groups: dict[tuple[int, int], tuple[list, list, list]] = {}
    for d, words in enumerate(documents):
        for low, high, a, b in tiles_of(len(words)):
            owners, starts, tiles = groups.setdefault((low, high), ([], [], []))
            owners.append(d)
            starts.append(a)
            tiles.append(words[a:b])
    found: list[list[dict]] = [[] for _ in documents]
    for (low, high), (owners, starts, tiles) in groups.items():
        for t, q, a, b in zip(*(c.tolist() for c in solve(tiles, low, high)), strict=True):
            found[owners[t]].append({"period": q, "start": starts[t] + a, "end": starts[t] + b})
    return found


def _sha256(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def plain(id: int | None, words: list[bytes]) -> list[bytes]:
    return words


def planted(id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten (by the checksum of its id) with a run planted, of others as they are, as of those without id."""
    h = zlib.crc32(str(id).encode()) if id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _searched(rows: DataFrame, prepare: Prepare, with_text: bool) -> DataFrame:
    """A record for each row of (row, id, text), and one for each tile of long documents, which are still to be solved.

    A document without any part of a run is done: it has its digest and, with_text, its words. Others have their text and their fragments.
    """
    schema = f"row long, id {rows.schema['id'].dataType.simpleString()}, n long, digest string, text string, fragments {FRAGMENTS}, low int, high int, start long, words binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, first = batch.column(1).to_pylist(), batch.column(2), 0
            held, words, size = [], [], 0
            for i in range(batch.num_rows):
                held.append(prepare(ids[i], words_of(texts[i].as_py())))
                words.append(numbered(held[-1]))
                size += len(held[-1])
                if size >= TOGETHER or i + 1 == batch.num_rows:
                    yield documents(batch.slice(first, i + 1 - first), held, words)
                    for j, one in enumerate(words):
                        if len(one) > DEALT_WORDS:
                            for tile in tiles_of(len(one)):
                                yield dealt(batch.slice(first + j, 1), one, *tile)
                    held, words, size, first = [], [], 0, i + 1

    def documents(batch: pa.RecordBatch, held: list[list[bytes]], words: list[np.ndarray]) -> pa.RecordBatch:
        long = [len(w) > DEALT_WORDS for w in words]
        fragments = _solved([w[:0] if dealt else w for w, dealt in zip(words, long, strict=True)])
        texts, digests = batch.column(2).to_pylist(), []
        for i, h in enumerate(held):
            done = not fragments[i] and not long[i]
            whole = b" ".join(h) if done else b""
            digests.append(_sha256(whole) if done else None)
            if done:
                texts[i] = whole.decode("utf-8", "surrogatepass") if with_text else None
        made = [batch.column(0), batch.column(1), pa.array([len(h) for h in held], pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
        none = [pa.nulls(len(held), t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.binary())]
        return pa.record_batch([*made, pa.array(fragments, _FRAGMENTS), *none], names)

    def dealt(one: pa.RecordBatch, words: np.ndarray, low: int, high: int, a: int, b: int) -> pa.RecordBatch:
        none = [pa.nulls(1, t) for t in (one.schema.field(1).type, pa.int64(), pa.string(), pa.string(), _FRAGMENTS)]
        tile = [pa.array([low], pa.int32()), pa.array([high], pa.int32()), pa.array([a], pa.int64()), pa.array([words[a:b].tobytes()])]
        return pa.record_batch([one.column(0), *none, *tile], names)

    return rows.mapInArrow(run, schema)


def _solved_tiles(tiles: DataFrame) -> DataFrame:
    """(row, period, start, end) of tiles (row, low, high, start, words), each solved by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, low, high, start, words in zip(*batch.columns, strict=True):
                _, q, a, b = solve([np.frombuffer(words.as_py(), np.int64).copy()], low.as_py(), high.as_py())
                at = start.as_py()
                yield pa.record_batch([pa.array(np.full(len(q), row.as_py())), pa.array(q), pa.array(a + at), pa.array(b + at)], ["row", "period", "start", "end"])

    return tiles.mapInArrow(run, "row long, period long, start long, end long")


def stitched(fragments: DataFrame) -> DataFrame:
    """The runs (row, start, length, period) of fragments of zones (row, period, start, end): those that overlap or touch are one."""
    at = W.partitionBy("row", "period").orderBy("start", "end")
    reach = F.max("end").over(at.rowsBetween(W.unboundedPreceding, -1))
    begun = fragments.withColumn("_new", (reach.isNull() | (reach < F.col("start"))).cast("int"))
    zones = begun.withColumn("_zone", F.sum("_new").over(at.rowsBetween(W.unboundedPreceding, 0)))
    whole = zones.groupBy("row", "period", "_zone").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.select("row", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any of the runs (start, length, period) holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, c in zip(words, np.cumsum(change[:-1]).tolist(), strict=True) if not c]


def periodic_runs(docs: DataFrame, prepare: Prepare = plain, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per row of docs: id, n_words, runs (by start, then period), runs_sha256, collapsed_sha256 and, with_text, collapsed.

    runs are all longest stretches of at least LEAST_WORDS words and LEAST_PERIODS of their least period. collapsed is the words but those that a
    run holds after its first period, joined by single spaces. prepare may change a document's words beforehand; it must give the
    same words each time. Null and blank texts have no words, a null id is kept, repeated rows stay repeated. Other columns are not read.
    runs_sha256 is of the lines `start,length,period`. Only texts with runs are read again, and shuffled for it.
    """
    session = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    path = fresh_path(session, "fragments")
    _searched(rows, prepare, with_text).write.parquet(path)
    records = session.read.parquet(path)
    searched, tiles = records.where("low IS NULL"), records.where("low IS NOT NULL").select("row", "low", "high", "start", "words")
    near = searched.select("row", F.explode("fragments").alias("_part")).select("row", "_part.period", "_part.start", "_part.end")
    found = stitched(near.unionByName(_solved_tiles(tiles.repartition("row", "low", "start"))))
    by_row = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    pending = searched.where("digest IS NULL").select("row", "id", "n", "text").join(by_row, "row", "left")
    schema = f"id {searched.schema['id'].dataType.simpleString()}, n_words long, runs {RUNS}, runs_sha256 string, collapsed_sha256 string, collapsed string"

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [[(r["start"], r["length"], r["period"]) for r in one or []] for one in batch.column(3).to_pylist()]
            ids, texts = batch.column(1).to_pylist(), batch.column(2)
            kept = [b" ".join(collapse(prepare(i, words_of(t.as_py())), one)) for i, t, one in zip(ids, texts, runs, strict=True)]
            lines = ["".join(f"{s},{n},{q}\n" for s, n, q in one).encode() for one in runs]
            structs = [[{"start": s, "length": n, "period": q} for s, n, q in one] for one in runs]
            digests = [pa.array(list(map(_sha256, x)), pa.string()) for x in (lines, kept)]
            whole = pa.array([x.decode("utf-8", "surrogatepass") if with_text else None for x in kept], pa.string())
            made = [batch.column(1), batch.column(4), pa.array(structs, _RUNS), *digests, whole]
            yield pa.record_batch(made, ["id", "n_words", "runs", "runs_sha256", "collapsed_sha256", "collapsed"])

    finished = pending.select("row", "id", "text", "runs", "n").mapInArrow(finish, schema)
    done = searched.where("digest IS NOT NULL").select(
        "id", F.col("n").alias("n_words"), F.array().cast(RUNS).alias("runs"), F.sha2(F.lit(""), 256).alias("runs_sha256"),
        F.col("digest").alias("collapsed_sha256"), F.col("text").alias("collapsed"),
    )
    every = done.unionByName(finished)
    return every if with_text else every.drop("collapsed")
