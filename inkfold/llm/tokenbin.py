"""Binary files of token ids in independently reset, checksummed blocks, packed by context mixing and range coding.

A block is cut into lanes that are coded in step, all by one model which starts afresh in each block. For the next id of a
lane the model has a guess from the two ids before it (order 2), one from the id before it (order 1), and the
adaptive counts of all ids so far (order 0). How often either guess has come true at its present confidence sets the
weights by which the three are mixed into one distribution; that drives a range coder with 64-bit state per lane. Encoder and
decoder learn from each step alike, in whole numbers only.

Block: magic, counts, CRC-32 of all that follows it; then document ids and lengths (packed), words per lane, the lanes' words.
"""

from __future__ import annotations

import itertools
import re
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkfold.llm.bpe import NEAR_LETTERS, Kept, byte_characters

#: Ids after which a block ends, at the end of a document; documents are never cut.
BLOCK_IDS = 1 << 21
#: Lanes of a large block; small ones have fewer, so that each lane has some hundred ids.
LANES = 8192
LANE_IDS = 256
#: Steps whose ids are turned from lanes to steps, or back, at a time.
_TURNED = 8
MAGIC = b"TIB1"
_HEAD = struct.Struct("<4sIIIII")  # magic, documents, ids, lanes, bytes of the directory, crc32

_TOTAL_BITS = 24
_ORDER0_BITS = 18
_SHARES = 1 << (_TOTAL_BITS - _ORDER0_BITS)
_TOP = np.uint64(1 << 48)
_BOTTOM = np.uint64(1 << 32)
_WORD = np.uint64(16)
_SLOTS = 18
_SURE_BITS, _SURE = 4, 15
_CASES = 2 * (_SURE + 1) ** 2
#: By whether order 2 (2) and order 1 (1) were right, where the outcomes of the cases begin.
_OUTCOME = np.array([2 * _CASES, _CASES, 0, 0])
#: By how sure a guess was and, _SURE + 1 further on, if it was right: what is added to it with its sureness. A wrong one at 0 goes.
_STEP = np.array([(s >> 1) - s for s in range(_SURE + 1)] + [min(s + 1, _SURE) - s for s in range(_SURE + 1)], np.int32)


class _Model:
    """Order-0 to order-2 predictions, learned step by step. vocabulary: one more than the largest id."""

    def __init__(self, lanes: int, vocabulary: int, decoding: bool):
        self.counts = np.zeros(vocabulary, np.int64)
        self.new: list[np.ndarray] = []
        self.seen = self.fresh = 0
        self.decoding = decoding
        # a guess and, in the lowest bits, how sure it is: of the last id, and of a hash of the last two
        self.table1, self.table2 = np.zeros(vocabulary, np.int32), np.zeros(1 << _SLOTS, np.int32)
        self.before, self.last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.below, self.every = np.zeros(vocabulary + 1, np.int32), np.arange(vocabulary, dtype=np.int32)
        # outcomes by the confidences and whether the guesses agree: order 2 right, only order 1 right, neither
        self.outcomes = np.ones((3, _CASES), np.int64)
        self.outcomes[2] += 1
        self._spread()
        self._weigh()

    def _spread(self) -> None:
        """Counts as frequencies of at least 1 that add up to the order-0 total."""
        if self.new:
            self.counts += np.bincount(np.concatenate(self.new), minlength=len(self.counts))
            self.new = []
        room = (1 << _ORDER0_BITS) - len(self.counts)
        shares = self.counts * room // max(self.seen, 1) + 1
        shares[int(self.counts.argmax())] += (1 << _ORDER0_BITS) - int(shares.sum())
        self.frequency = shares.astype(np.int32)
        np.cumsum(self.frequency, dtype=np.int32, out=self.below[1:])
        if self.decoding:
            self.id_at = np.repeat(self.every, shares)
        self.fresh = 0

    def _weigh(self) -> None:
        """For each case the shares of order 0 (in 64ths of the total) and the masses of the two guesses."""
        two, one, none = self.outcomes
        zero = np.minimum(np.maximum(none * _SHARES // (two + one + none), 1), _SHARES - 1)
        rest = (_SHARES - zero) << _ORDER0_BITS
        mass2 = rest * two // (two + one)
        self.zero, self.mass2, self.mass1 = zero.astype(np.int32), mass2.astype(np.int32), (rest - mass2).astype(np.int32)

    def predict(self) -> tuple[np.ndarray, ...]:
        """Guesses of order 2 and 1, their masses, the share of order 0."""
        self.slot = ((self.before * 0x9E3779B1 + self.last * 0x85EBCA6B) >> 7) & ((1 << _SLOTS) - 1)
        held2, held1 = self.table2.take(self.slot), self.table1.take(self.last)
        self.held2, self.held1, self.s2, self.s1 = held2, held1, held2 & _SURE, held1 & _SURE
        g2, g1 = held2 >> _SURE_BITS, held1 >> _SURE_BITS
        self.case = ((((self.s2 << _SURE_BITS) | self.s1) << 1) | (g1 == g2)).astype(np.int64)
        return g2, g1, self.mass2.take(self.case), self.mass1.take(self.case), self.zero.take(self.case)

    def learn(self, ids: np.ndarray, right2: np.ndarray, right1: np.ndarray) -> None:
        """ids: what came; right2, right1: where the guesses said so, as booleans."""
        right2, right1 = right2.view(np.uint8), right1.view(np.uint8)
        self.outcomes += np.bincount(_OUTCOME.take(right2 * 2 + right1) + self.case, minlength=3 * _CASES).reshape(3, _CASES)
        if self.seen >> 20 != (self.seen + len(ids)) >> 20:
            self.outcomes = (self.outcomes >> 1) + 1
        self._weigh()
        new = (ids << _SURE_BITS).astype(np.int32)
        for table, at, held, right, sure in ((self.table2, self.slot, self.held2, right2, self.s2), (self.table1, self.last, self.held1, right1, self.s1)):
            how = sure.astype(np.uint8) | (right << _SURE_BITS)
            held += _STEP.take(how)
            held ^= (held ^ new) & -(how == 0).astype(np.int32)
            table[at] = held
        self.new.append(ids)
        self.seen += len(ids)
        self.fresh += len(ids)
        if self.fresh * 16 >= self.seen or self.fresh >= 1 << 16:
            self._spread()
        self.before, self.last = self.last, ids


def _lanes(n: int) -> int:
    return max(1, min(LANES, n // LANE_IDS))


def pack_ids(ids: np.ndarray) -> tuple[int, int, bytes]:
    """Lanes, vocabulary and the coded bytes of a block's ids."""
    lanes = _lanes(len(ids))
    steps = -(-len(ids) // lanes)
    vocabulary = int(ids.max()) + 1 if len(ids) else 1
    if vocabulary > 1 << (_ORDER0_BITS - 1):
        raise ValueError("ids are too large for this coder")
    padded = np.zeros(lanes * steps, np.int32)
    padded[: len(ids)] = ids
    table = padded.reshape(lanes, steps)
    model = _Model(lanes, vocabulary, False)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    whose: list[np.ndarray] = []
    words: list[np.ndarray] = []
    every = np.arange(lanes)
    for s in itertools.chain.from_iterable(np.ascontiguousarray(table[:, t : t + _TURNED].T) for t in range(0, steps, _TURNED)):
        g2, g1, m2, m1, zero = model.predict()
        right2, right1, ids = g2 == s, g1 == s, s.astype(np.int64)
        start = zero * model.below.take(ids) + m2 * (g2 < s) + m1 * (g1 < s)
        size = zero * model.frequency.take(ids) + m2 * right2 + m1 * right1
        width >>= np.uint64(_TOTAL_BITS)
        low += start.astype(np.uint64) * width
        width *= size.astype(np.uint64)
        at, own_low, own_width = every, low, width
        while True:
            settled = (own_low ^ (own_low + own_width)) < _TOP
            move = np.flatnonzero(settled | (own_width < _BOTTOM))
            if not len(move):
                break
            at, own_low, own_width, settled = at[move], own_low[move], own_width[move], settled[move]
            if not settled.all():
                own_width = np.where(settled, own_width, (~own_low + np.uint64(1)) & (_BOTTOM - np.uint64(1)))
            whose.append(at.astype(np.uint16))
            words.append((own_low >> np.uint64(48)).astype(np.uint16))
            own_low <<= _WORD
            own_width <<= _WORD
            low[at], width[at] = own_low, own_width
        model.learn(ids, right2, right1)
    for _ in range(4):
        whose.append(every.astype(np.uint16))
        words.append((low >> np.uint64(48)).astype(np.uint16))
        low <<= _WORD
    lane = np.concatenate(whose)
    order = np.argsort(lane, kind="stable")
    return lanes, vocabulary, np.bincount(lane, minlength=lanes).astype("<u4").tobytes() + np.concatenate(words)[order].astype("<u2").tobytes()


def unpack_ids(n: int, lanes: int, vocabulary: int, data: bytes) -> np.ndarray:
    """The ids that pack_ids() coded."""
    steps = -(-n // lanes)
    sizes = np.frombuffer(data, "<u4", lanes).astype(np.int64)
    words = np.concatenate((np.frombuffer(data, "<u2", offset=4 * lanes), np.zeros(4, np.uint16)))
    at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    model = _Model(lanes, vocabulary, True)
    low, width, code = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64), np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << _WORD) | words[at].astype(np.uint64)
        at += 1
    table, few = np.zeros((lanes, steps), np.int32), np.zeros((_TURNED, lanes), np.int32)
    every = np.arange(lanes)
    for t in range(steps):
        g2, g1, m2, m1, zero = model.predict()
        width >>= np.uint64(_TOTAL_BITS)
        target = np.minimum((code - low) // width, np.uint64((1 << _TOTAL_BITS) - 1)).astype(np.int32)
        # the guesses' masses lie in the order-0 line where their ids are
        id2, id1, apart = g2.astype(np.int64), g1.astype(np.int64), g1 != g2
        start2 = zero * model.below.take(id2) + m1 * (g1 < g2)
        start1 = zero * model.below.take(id1) + m2 * (g2 < g1)
        past2 = start2 + zero * model.frequency.take(id2) + m2 + m1 * ~apart
        past1 = start1 + zero * model.frequency.take(id1) + m1 + m2 * ~apart
        right2, right1 = (target >= start2) & (target < past2), (target >= start1) & (target < past1)
        rest = target - m2 * (target >= past2) - m1 * (target >= past1)
        other = np.flatnonzero(~(right2 | right1))
        s = g1 ^ ((g1 ^ g2) & -right2.astype(np.int32))
        s[other] = model.id_at.take(rest.take(other) // zero.take(other))
        ids = s.astype(np.int64)
        start = zero * model.below.take(ids) + m2 * (g2 < s) + m1 * (g1 < s)
        size = zero * model.frequency.take(ids) + m2 * right2 + m1 * right1
        low += start.astype(np.uint64) * width
        width *= size.astype(np.uint64)
        whose, own_low, own_width = every, low, width
        while True:
            settled = (own_low ^ (own_low + own_width)) < _TOP
            move = np.flatnonzero(settled | (own_width < _BOTTOM))
            if not len(move):
                break
            whose, own_low, own_width, settled = whose[move], own_low[move], own_width[move], settled[move]
            if not settled.all():
                own_width = np.where(settled, own_width, (~own_low + np.uint64(1)) & (_BOTTOM - np.uint64(1)))
            own_at = at[whose]
            code[whose] = (code[whose] << _WORD) | words[own_at].astype(np.uint64)
            at[whose] = own_at + 1
            own_low <<= _WORD
            own_width <<= _WORD
            low[whose], width[whose] = own_low, own_width
        few[t % _TURNED] = s
        if (t + 1) % _TURNED == 0 or t + 1 == steps:
            table[:, t - t % _TURNED : t + 1] = few[: t % _TURNED + 1].T
        model.learn(ids, right2, right1)
    return table.reshape(-1)[:n].astype(np.int64)


def pack_block(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    """A block of whole documents."""
    sizes = np.array([len(d) for d in docs], np.int64)
    ids = np.concatenate(docs).astype(np.int64) if docs else np.empty(0, np.int64)
    names = np.array([0 if d is None else d for d in doc_ids], np.int64)
    lacking = np.array([d is None for d in doc_ids], np.uint8)
    directory = zlib.compress(np.diff(names, prepend=0).astype("<i8").tobytes() + sizes.astype("<i8").tobytes() + lacking.tobytes(), 1)
    lanes, vocabulary, packed = pack_ids(ids)
    body = struct.pack("<I", vocabulary) + directory + packed
    return _HEAD.pack(MAGIC, len(docs), len(ids), lanes, len(directory), zlib.crc32(body)) + body


def unpack_block(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, and all ids of a block. Raises ValueError for a block that is damaged."""
    if len(data) < _HEAD.size:
        raise ValueError("a block is cut off")
    magic, n_docs, n, lanes, n_directory, crc = _HEAD.unpack_from(data)
    body = memoryview(data)[_HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("a block does not have its checksum")
    vocabulary = struct.unpack_from("<I", body)[0]
    directory = zlib.decompress(body[4 : 4 + n_directory])
    names = np.cumsum(np.frombuffer(directory, "<i8", n_docs))
    sizes = np.frombuffer(directory, "<i8", n_docs, 8 * n_docs)
    lacking = np.frombuffer(directory, np.uint8, n_docs, 16 * n_docs)
    doc_ids = [None if x else int(d) for d, x in zip(names, lacking, strict=True)]
    return doc_ids, sizes, unpack_ids(n, lanes, vocabulary, body[4 + n_directory :])


_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for texts of near characters, for Python's quicker matcher, which knows no \p{L} and \p{N}.
_NEAR_PIECES = re.compile(rf" ?[{NEAR_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: What is not near: control characters that only Python takes for white space, digits past ASCII, other scripts.
_NOT_NEAR = re.compile(r"[^\t-\r -\xb1\xb4-\xb8\xba\xbb\xbf-\u017f\u2010-\u2027]")
#: Characters of scripts on which the libraries' tables of letters might differ.
_FAR = re.compile(r"[^\x00-\u036f\u0400-\u052f\u2010-\u2027]")
_KEPT_PIECES = 1_500_000
#: Fewer words than these are not made distinct first.
_FEW_WORDS = 256
#: Characters of texts that are cut into pieces one by one before these are looked up.
_PIECED_AT_ONCE = 1 << 20
#: The ids of texts of about so many words are put together at a time.
_GATHERED_WORDS = 1 << 15


_SPACE, _STRANGE, _DISTANT = 1, 2, 4
#: By code point, what the matchers above find it to be; the last one stands for all beyond.
_KINDS = np.array([_SPACE * c.isspace() + _STRANGE * bool(_NOT_NEAR.match(c)) + _DISTANT * bool(_FAR.match(c)) for c in map(chr, range(0x3001))], np.uint8)


def _kinds(text: str) -> np.ndarray:
    return _KINDS[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), len(_KINDS) - 1)]


def _words_barred(words: Sequence[str], joined: np.ndarray) -> np.ndarray:
    """Which words are empty, begin or end with white space, or have far characters. joined: the kinds of the words joined by blanks."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    begins = np.concatenate(([0], ends[:-1] + 1))
    edge, far = np.concatenate(((joined & _SPACE) > 0, [True])), (joined & _DISTANT) > 0
    barred = (begins == ends) | edge[begins] | edge[ends - 1]
    if far.any():
        upto = np.concatenate(([0], np.cumsum(far)))
        barred |= upto[ends] > upto[begins]
    return barred


def _room(held: np.ndarray, n: int) -> np.ndarray:
    """An array that begins like the one held and has room for n."""
    return held if n <= len(held) else np.concatenate((held, np.zeros(max(n - len(held), len(held)), held.dtype)))


def _runs(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of flat with those begins and lengths, one after another."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Ids by the tokenizers library, asked once for each piece of text that its pre-tokenizer cuts off.

    Texts with a special token's name or with far scripts are given to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.characters = dict(enumerate(byte_characters()))
        # pieces' numbers; their ids lie one after another, from bounds[number] to bounds[number + 1]; blank: whether they begin with one
        self.kept = Kept(self._piece_ids)
        self.n_kept, self.ids, self.bounds, self.blank = 0, np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, bool)
        cut = self.library.pre_tokenizer
        self.by_piece = cut is not None and "ByteLevel" in repr(cut) and self.library.normalizer is None

    def _pieces(self, text: str) -> list[str] | None:
        """The pieces of a text, or None if the library has to see it whole."""
        if not self.by_piece or any(s in text for s in self.special):
            return None
        if not _NOT_NEAR.search(text):
            return _NEAR_PIECES.findall(text)
        return None if _FAR.search(text) else _PIECES.findall(text)

    def _translated(self, text: str) -> str:
        """A text's bytes as the vocabulary's characters."""
        return text.encode("utf-8", "replace").decode("latin-1").translate(self.characters)

    def _piece_ids(self, piece: str) -> int:
        """Keeps the ids of a piece; their number."""
        ids = [t.id for t in self.model.tokenize(self._translated(piece))]
        return self._append([piece], np.array(ids, np.uint32), np.array([len(ids)]))

    def _append(self, pieces: list[str], ids: np.ndarray, ends: np.ndarray) -> int:
        """Lays the ids of pieces, which end there in ids, beside those that are kept. The first piece's number; the others follow."""
        first, at = self.n_kept, int(self.bounds[self.n_kept])
        self.n_kept += len(pieces)
        self.ids, self.bounds, self.blank = _room(self.ids, at + len(ids)), _room(self.bounds, self.n_kept + 1), _room(self.blank, self.n_kept)
        self.ids[at : at + len(ids)] = ids
        self.bounds[first + 1 : self.n_kept + 1] = at + ends
        self.blank[first : self.n_kept] = [p[0] == " " for p in pieces]
        return first

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """The numbers of pieces; those that are not kept yet are asked for together."""
        numbers = np.fromiter(map(self.kept.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        lacking = np.flatnonzero(numbers < 0)
        if len(lacking):
            new = [pieces[i] for i in lacking.tolist()]
            numbers[lacking] = np.fromiter(map(self._keep(list(dict.fromkeys(new))).__getitem__, new), np.int64, len(new))
        return numbers

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after another, and how many each has."""
        begins = self.bounds[numbers]
        lengths = self.bounds[numbers + 1] - begins
        return _runs(self.ids, begins, lengths), lengths

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        """The ids of each text with the id end after them."""
        if len(self.kept) > _KEPT_PIECES:
            self.kept.clear()
            self.n_kept = 0
        texts = [t or "" for t in texts]
        out: list[np.ndarray | None] = [None] * len(texts)
        if self.by_piece:
            self._by_word(texts, [i for i, t in enumerate(texts) if " " in t and not any(s in t for s in self.special)], end, out)
        group, size = [], 0
        for i, text in enumerate(texts):
            if out[i] is None:
                group.append(i)
                size += len(text)
                if size > _PIECED_AT_ONCE:
                    self._by_text(texts, group, end, out)
                    group, size = [], 0
        self._by_text(texts, group, end, out)
        return out

    def _by_text(self, texts: list[str], rows: list[int], end: int, out: list[np.ndarray | None]) -> None:
        """Puts the same into out for those rows, each text cut into pieces or given to the library by itself."""
        cut = []
        for i in rows:
            own = self._pieces(texts[i])
            if own is None:
                out[i] = np.array([*self.library.encode(texts[i], add_special_tokens=False).ids, end], np.uint32)
            else:
                cut.append((i, own))
        if not cut:
            return
        flat, lengths = self._ids_of(self._numbers([p for _, own in cut for p in own]))
        upto = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum([0, *(len(own) for _, own in cut)])].tolist()
        last = np.array([end], np.uint32)
        for (i, _), a, b in zip(cut, upto, upto[1:], strict=False):
            out[i] = np.concatenate((flat[a:b], last))

    def _by_word(self, texts: list[str], rows: list[int], end: int, out: list[np.ndarray | None]) -> None:
        """Puts the same into out for those rows, all with blanks, of texts whose words are tight and of near scripts.

        A piece has no blank but at its begin, so a word with the blank before it is whole pieces whatever is around it, if no
        white space touches that blank. Each of the texts' distinct words is cut into pieces once; a text's ids are put
        together from those of its words.
        """
        if not rows:
            return
        heads, tails = zip(*(texts[i].split(" ", 1) for i in rows), strict=True)
        split = pc.split_pattern(pa.array(tails, pa.string()), " ")
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        if sizes.sum() < _FEW_WORDS:
            return
        found = split.flatten().dictionary_encode()
        words, at = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy(zero_copy_only=False)
        joined, begun = " ".join(words), " ".join(heads)
        kinds, first = _kinds(joined), _kinds(begun)
        bad, bad_first = _words_barred(words, kinds), _words_barred(heads, first)
        if bad.any() or bad_first.any():
            fit = ~(np.logical_or.reduceat(bad[at], np.cumsum(sizes) - sizes) | bad_first)
            return self._by_word(texts, [i for i, fits in zip(rows, fit.tolist(), strict=True) if fits], end, out)
        cut = _PIECES if (kinds & _STRANGE).any() or (first & _STRANGE).any() else _NEAR_PIECES
        numbers = self._numbers(cut.findall(" " + joined))
        flat, long = self._ids_of(numbers)
        lengths = np.add.reduceat(long, np.flatnonzero(self.blank[numbers]))
        shift = np.cumsum(lengths) - lengths
        begun = [cut.findall(head) for head in heads]
        first, long = self._ids_of(self._numbers(list(itertools.chain.from_iterable(begun))))
        first_ends = np.cumsum(long)[np.cumsum(list(map(len, begun))) - 1].tolist()
        # some texts at a time, whose arrays stay in the processor's cache
        upto, last, a = np.concatenate(([0], np.cumsum(sizes))), np.array([end], np.uint32), 0
        for b in [*(np.flatnonzero(np.diff(upto[1:] // _GATHERED_WORDS)) + 1).tolist(), len(rows)]:
            own = at[upto[a] : upto[b]]
            long = lengths[own]
            every, cuts = _runs(flat, shift[own], long), np.cumsum(long)[upto[a + 1 : b + 1] - upto[a] - 1].tolist()
            for k, x, y in zip(range(a, b), [0, *cuts], cuts, strict=False):
                out[rows[k]] = np.concatenate((first[first_ends[k - 1] if k else 0 : first_ends[k]], every[x:y], last))
            a = b

    def _keep(self, new: list[str]) -> dict[str, int]:
        """Asks the library for distinct pieces that are not kept yet, prepared together if they can be told apart when joined. Their numbers."""
        joined = "\0".join(new)
        if joined.count("\0") >= len(new):
            return {p: self.kept[p] for p in new}
        ids, ends = [], []
        for tokens in map(self.model.tokenize, self._translated(joined).split(self.characters[0])):
            ids += [t.id for t in tokens]
            ends.append(len(ids))
        first = self._append(new, np.array(ids, np.uint32), np.array(ends))
        found = dict(zip(new, range(first, self.n_kept), strict=True))
        self.kept.update(found)
        return found


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


#: Bytes of text in a shard, about; a session's shuffle partitions where those are more.
SHARD_BYTES = 512 << 20
#: Rows of one id are dealt over shards by so many first characters of their texts, in the texts' order.
RANGE_CHARACTERS = 64
#: Characters of text that a task hands to the encoder at once, and for how many a row counts beside its text.
_AT_ONCE = 1 << 23
_ROW = 64


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = 0, parts: int | None = None
) -> None:
    """Writes the token ids of docs, in ascending order of id, as a table of blocks (shard, block, n_docs, n_ids, data) at path.

    A shard is a range of ids, its blocks follow one another. Null ids stand first; repeated ids follow each other, by
    text; a range may end between texts of one id, if they differ in their first characters. A null text is empty and has the end id alone. tokenizer: a file of the tokenizers library that executors have.
    """
    session = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if parts is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    ordered = rows.repartitionByRange(parts, "id", F.left("text", F.lit(RANGE_CHARACTERS))).sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own = TaskContext.get().partitionId(), encoder(tokenizer)
        held: list[tuple[int | None, np.ndarray]] = []
        size = block = 0
        for names, texts in _slices(batches):
            for name, ids in zip(names, own.encode(texts, end), strict=True):
                held.append((name, ids))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield _row(shard, block, held)
                    held, size, block = [], 0, block + 1
        if held:
            yield _row(shard, block, held)

    made = ordered.mapInArrow(run, "shard int, block int, n_docs long, n_ids long, data binary")
    made.write.option("compression", "uncompressed").parquet(path)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the rows of several batches, bounded by the texts' size: the more of them, the fewer distinct words for each."""
    names, texts, size = [], [], 0
    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            names.append(name)
            texts.append(text.as_py())
            size += len(texts[-1]) + _ROW
            if size > _AT_ONCE:
                yield names, texts
                names, texts, size = [], [], 0
    if names:
        yield names, texts


def _row(shard: int, block: int, held: list[tuple[int | None, np.ndarray]]) -> pa.RecordBatch:
    data = pack_block([h[0] for h in held], [h[1] for h in held])
    n = sum(len(h[1]) for h in held)
    return pa.record_batch(
        [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(held)]), pa.array([n]), pa.array([data])],
        ["shard", "block", "n_docs", "n_ids", "data"],
    )


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files at path: id, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    ids is null unless with_ids. The CRC-32 is of the ids as little-endian unsigned 32-bit integers.
    """
    files = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                names, sizes, ids = unpack_block(data.as_py())
                flat = ids.astype("<u4")
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(flat[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                n = len(names)
                lists = pa.nulls(n, pa.list_(pa.int32()))
                if with_ids:
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.record_batch(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(np.full(n, shard.as_py(), np.int32)),
                        pa.array(np.full(n, block.as_py(), np.int32)),
                        pa.array(ends - sizes),
                        pa.array(sizes),
                        pa.array(crc, pa.int64()),
                        lists,
                    ],
                    ["id", "shard", "block", "inside", "n_tokens", "ids_crc32", "ids"],
                )

    found = files.select("shard", "block", "data").mapInArrow(
        run, "id long, shard int, block int, inside long, n_tokens long, ids_crc32 long, ids array<int>"
    )
    return found.join(_block_starts(files), ["shard", "block"]).select(
        "id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def _block_starts(files: DataFrame) -> DataFrame:
    """Ids before each block: of earlier shards (as many rows as shards) and of earlier blocks of its shard."""
    sizes = files.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    up_to = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("earlier"))
    inside = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = sizes.withColumn("within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return blocks.join(shards, "shard").select("shard", "block", (F.col("earlier") + F.col("within")).alias("before"))
