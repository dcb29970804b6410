"""BPE encoding and decoding by merge ranks, for vocabularies of words with an end mark.

A word of usual length is merged in a contiguous array: its part boundaries and, beside each, the rank of merging the parts
that meet there. The least rank is looked for again and again, its boundary deleted and the two neighbouring ranks looked
up anew. Long words take a heap over linked parts instead, which gives the same merges without a quadratic scan.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.common import map_batches

#: Words up to so many parts are merged in the rank array.
SHORT_WORD = 96
#: Words whose ids a task keeps; past that it forgets them all and starts again.
KEPT_WORDS = 400_000
NO_RANK = 1 << 60

#: How the vocabulary's file cuts words, and the same for texts of near characters in Python's own, quicker matcher. Fixed values.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NEAR_LETTERS = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NEAR_WORDS = rf"[{NEAR_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\s\w]|_)+"
#: What is not near: control characters that only Python takes for white space, digits past ASCII, other scripts.
_NOT_NEAR = re.compile(r"[^\t-\r -\xb1\xb4-\xb8\xba\xbb\xbf-\u017f\u2010-\u2027]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from U+0100 on, in byte order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


def _text_of(settings: dict | None, kind: str) -> list[dict]:
    """The steps of a normalizer or pre-tokenizer, whether one or a sequence."""
    if settings is None:
        return []
    return settings.get(kind, [settings]) if settings["type"] == "Sequence" else [settings]


class Kept(dict):
    """Values by key, made where they are asked for first."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.make(key)
        return value


class WordBpe:
    """Encoder and decoder for one tokenizer file of the kind with word ends (its path is a parameter)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, steps = spec["model"], _text_of(spec["normalizer"], "normalizers")
        cuts = _text_of(spec["pre_tokenizer"], "pretokenizers")
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in cuts] != ["Split", "ByteLevel"]:
            raise ValueError("not a tokenizer file of the kind with word ends")
        if spec["decoder"] is not None or cuts[0]["behavior"] != "Removed" or not cuts[0]["invert"]:
            raise ValueError("not a tokenizer file of the kind with word ends")
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks: dict[tuple[str, str], int] = {p: rank for rank, p in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = regex.compile("|".join(map(regex.escape, longest_first))) if self.special else None
        pattern = cuts[0]["pattern"]["Regex"]
        self.words = regex.compile(pattern, regex.V0)
        self.near_words = re.compile(_NEAR_WORDS) if pattern == _WORDS else None
        self.space = regex.compile(steps[1]["pattern"]["Regex"])
        self.blank = steps[1]["content"]
        names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.gaps = "" in self.names
        self.characters = byte_characters()
        self.kept = Kept(self._word_ids)

    def parts(self, word: str) -> list[str]:
        """A word's parts after all merges."""
        parts = [self.characters[b] for b in word.encode("utf-8", "replace")]
        if not parts:
            return []
        parts[-1] += self.end
        return self._scan(parts) if len(parts) <= SHORT_WORD else self._heap(parts)

    def _scan(self, parts: list[str]) -> list[str]:
        ranks = self.ranks
        text, bounds = "".join(parts), [0]
        for p in parts:
            bounds.append(bounds[-1] + len(p))
        # around[i]: rank of merging the part that starts at bounds[i] with the next; the last part has no next
        around = [ranks.get(pair, NO_RANK) for pair in zip(parts, parts[1:], strict=False)]
        around.append(NO_RANK)
        while len(around) > 1:
            least = min(around)
            if least == NO_RANK:
                break
            i = around.index(least)
            del bounds[i + 1], around[i + 1]
            joined = text[bounds[i] : bounds[i + 1]]
            around[i] = ranks.get((joined, text[bounds[i + 1] : bounds[i + 2]]), NO_RANK) if i + 2 < len(bounds) else NO_RANK
            if i:
                around[i - 1] = ranks.get((text[bounds[i - 1] : bounds[i]], joined), NO_RANK)
        return [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _heap(self, parts: list[str]) -> list[str]:
        ranks, n = self.ranks, len(parts)
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue = [(ranks[p], i, *p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if not live[i] or j >= n or parts[i] != left or parts[j] != right:
                continue
            parts[i] = left + right
            live[j] = False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (parts[a], parts[b]) in ranks:
                    heapq.heappush(queue, (ranks[parts[a], parts[b]], a, parts[a], parts[b]))
        return [p for p, x in zip(parts, live, strict=True) if x]

    def _word_ids(self, word: str) -> bytes:
        """The ids of a word as int32 bytes."""
        return array("i", [self.ids[p] for p in self.parts(word) if p in self.ids]).tobytes()

    def normalized(self, text: str) -> str:
        """Composed, white space runs as one blank, lower case letter by letter (a final sigma is an ordinary one)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = self.space.sub(self.blank, text)
        return text.replace("Σ", "σ").lower()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text, without tokens of the model's own; names of special tokens in the text become their ids."""
        pieces, made, ids_of = self._pieces(text or ""), [], self.kept.__getitem__
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        for piece in pieces:
            if isinstance(piece, int):
                made.append(np.int32(piece).tobytes())
            else:
                made += map(ids_of, self._words(piece))
        return np.frombuffer(b"".join(made), np.int32)

    def _words(self, text: str) -> list[str]:
        """The words of a text after normalization. White space never counts, so near texts need not have it replaced."""
        if self.near_words is None or _NOT_NEAR.search(text):
            return self.words.findall(self.normalized(text))
        return self.near_words.findall((text if text.isascii() else unicodedata.normalize("NFC", text)).lower())

    def _pieces(self, text: str) -> Iterator[str | int]:
        start = 0
        for found in self.at_special.finditer(text) if self.at_special and "<" in text else ():
            if found.start() > start:
                yield text[start : found.start()]
            yield self.special[found.group()]
            start = found.end()
        if start < len(text):
            yield text[start:]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids with one blank between; ids that the vocabulary lacks give nothing."""
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= len(self.names)):
            ids = ids[(ids >= 0) & (ids < len(self.names))]
        found = map(self.names.__getitem__, ids.tolist())
        return " ".join(filter(None, found) if self.gaps else found)


_LOADED: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """The tokenizer of a file, read once per process, so that tasks in one worker share the ids of words they know."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, ids array<int>) per row of docs. path: a tokenizer file that every executor has.

    A null or empty text has no ids. Repeated rows stay repeated; other columns are not read.
    """

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        bpe = tokenizer(path)
        made = [bpe.encode(text.as_py()) for text in rows.column(1)]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in made]))).astype(np.int32)
        flat = pa.array(np.concatenate(made) if made else np.empty(0, np.int32))
        return pa.record_batch([rows.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat)], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, batch, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """One row (id, ids, text) per row of encoded. Null ids give an empty text."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        bpe = tokenizer(path)
        column = rows.column(1)
        texts = [bpe.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in column]
        return pa.record_batch([rows.column(0), column, pa.array(texts, pa.string())], ["id", "ids", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return map_batches(rows, batch, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, text string")
