import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inkfold.llm import tokenbin as t
from inkfold.llm.common import fresh_path
from inkfold.llm.queries import QUERIES, tokenizer_path
from tests.llm.helpers import SF, documents, empty

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.mark.parametrize("ids", [[], [0], [50256] * 700, list(range(3000)), [7, 7, 8] * 900])
def test_round_trip(ids):
    ids = np.array(ids, np.int64)
    lanes, vocabulary, data = t.pack_ids(ids)
    assert t.unpack_ids(len(ids), lanes, vocabulary, data).tolist() == ids.tolist()


def test_random_round_trips_and_size():
    rng = np.random.default_rng(3)
    for n in (1, 255, 256, 5000, 70_000):
        ids = rng.zipf(1.3, n) % 50_257
        lanes, vocabulary, data = t.pack_ids(ids)
        assert (t.unpack_ids(n, lanes, vocabulary, data) == ids).all()
    assert len(data) < 2 * n
    with pytest.raises(ValueError):
        t.pack_ids(np.array([1 << 20]))


def test_blocks_are_checked():
    block = t.pack_block([5, None, -3], [np.array([1, 2, 0]), np.array([0]), np.array([], np.int64)])
    names, sizes, ids = t.unpack_block(block)
    assert names == [5, None, -3] and sizes.tolist() == [3, 1, 0] and ids.tolist() == [1, 2, 0, 0]
    for at in (3, len(block) // 2, len(block) - 1):
        with pytest.raises(ValueError):
            t.unpack_block(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :])
    with pytest.raises(ValueError):
        t.unpack_block(block[:10])


def test_pieces_give_the_library_s_ids():
    library, own, rng = Tokenizer.from_file(PATH), t.Encoder(PATH), random.Random(7)
    letters = "ab é_'’²½ \n\t\x1c\x85\xa0st'reВЖ中9.,ʼ"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) + rng.choice(["", "<|endoftext|>x"])
        assert own.encode([text], 0)[0].tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], text


def test_words_of_many_texts_give_the_library_s_ids(monkeypatch):
    """Texts encoded together, whose words are looked up once: loose blanks, far scripts, special names and NULs beside plain texts."""
    monkeypatch.setattr(t, "_FEW_WORDS", 0)
    library, own, rng = Tokenizer.from_file(PATH), t.Encoder(PATH), random.Random(8)
    letters = "ab é_'’² \n\t\x1c\x85\xa0st'reВЖ中9.,\0  "
    for k in range(400):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) + rng.choice(["", "", "<|endoftext|>x"]) for _ in range(6)]
        texts = [*texts, *(" ".join(w.strip() or "x" for w in x.split(" ")) for x in texts), None, "é'd it's  so", " a b", "a b ", "a\nb c\n\nd 12"]
        for text, ids in zip(texts, own.encode(texts, 0), strict=True):
            assert ids.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 0], text


def test_a_word_is_looked_up_once_for_many_texts():
    class Counted(t.Kept):
        asked = 0

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    own = t.Encoder(PATH)
    own.kept = Counted(own._piece_ids)
    texts = [" ".join(f"word{(i * j) % 50}" for i in range(200)) for j in range(40)]
    want = [[*own.library.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    assert [ids.tolist() for ids in own.encode(texts, 0)] == want and Counted.asked < 1000


def test_rows_of_several_batches_are_encoded_together(monkeypatch):
    """Up to a size, for which empty texts count as well."""
    batch = pa.record_batch([pa.array(range(10)), pa.array(["some words"] * 10)], ["id", "text"])
    assert [(len(names), len(texts)) for names, texts in t._slices(iter([batch] * 5))] == [(50, 50)]
    monkeypatch.setattr(t, "_AT_ONCE", 1000)
    nothing = pa.record_batch([pa.array(range(100)), pa.array([""] * 100)], ["id", "text"])
    found = list(t._slices(iter([batch, nothing, batch])))
    assert max(len(names) for names, _ in found) < 20
    assert [x for names, _ in found for x in names] == [*range(10), *range(100), *range(10)]


def test_pieces_are_kept_within_a_limit(monkeypatch):
    """Pieces forgotten between calls, while ids returned before stay as they are; arrays that outgrow their room."""
    monkeypatch.setattr(t, "_KEPT_PIECES", 1000)
    library, own, got = Tokenizer.from_file(PATH), t.Encoder(PATH), []
    rounds = [[" ".join(f"w{k}{i * j % 1777:x}é" for i in range(600)) for j in (1, 7, 11)] + ["", "x\0 y", None] for k in range(12)]
    for texts in rounds:
        got += own.encode(texts, 5)
        assert own.n_kept == len(own.kept) < 12_000
    for text, ids in zip((x for texts in rounds for x in texts), got, strict=True):
        assert ids.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 5]


def test_loose_texts_are_looked_up_in_groups(monkeypatch):
    """Texts that are cut into pieces by themselves, some at a time, between others; each piece that is not kept is asked for with others."""
    monkeypatch.setattr(t, "_PIECED_AT_ONCE", 100)
    library, own, asked = Tokenizer.from_file(PATH), t.Encoder(PATH), []
    own.kept = t.Kept(lambda piece: asked.append(piece) or own._piece_ids(piece))
    texts = [f"two  blanks{i}\n here,  {i}" if i % 3 else f"中{i}" if i % 2 else f"tight words {i}" for i in range(60)] + ["", None, " "]
    assert [x.tolist() for x in own.encode(texts, 0)] == [[*library.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]
    assert asked == []


def test_the_format_stays():
    """The bytes that earlier versions wrote for the same ids, guesses right and wrong among them."""
    rng = np.random.default_rng(11)
    ids = np.concatenate((rng.zipf(1.3, 60_000) % 50_257, np.tile(rng.integers(0, 50_257, 50), 900), np.full(5000, 7)))
    assert zlib.crc32(t.pack_ids(ids)[2]) == 1344516776
    assert t.unpack_block(t.pack_block([3], [ids]))[2].tolist() == ids.tolist()


def expected(docs):
    library, at, out = Tokenizer.from_file(PATH), 0, []
    for name, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((name, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files(spark):
    docs, path = documents(spark), fresh_path(spark, "tokens")
    t.write_tokens(docs, PATH, path, parts=3)
    found = t.read_tokens(spark, path).orderBy("start", "n_tokens").collect()
    assert [(r.id, r.start, r.n_tokens, r.ids_crc32) for r in found] == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)


def test_empty_table(spark):
    path = fresh_path(spark, "tokens")
    t.write_tokens(empty(spark), PATH, path)
    assert t.read_tokens(spark, path).collect() == []


def test_query(spark):
    found = QUERIES["op8_token_ids"](spark, SF).orderBy("start").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert [tuple(r) for r in found] == expected([tuple(r) for r in docs])


def test_rows_of_one_id_are_dealt_over_shards(spark):
    """Half of the rows have no id, a third have one and the same; no shard holds more than a few times its share, and the order stays."""
    docs = spark.range(6000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN NULL WHEN id % 6 < 5 THEN 7L ELSE id END AS doc_id", "concat(crc32(string(id)), ' words of ', id) AS text"
    )
    path = fresh_path(spark, "tokens")
    t.write_tokens(docs, PATH, path, parts=8)
    shards = {r.shard: r.n for r in spark.read.parquet(path).groupBy("shard").agg(F.sum("n_docs").alias("n")).collect()}
    assert sum(shards.values()) == 6000 and max(shards.values()) < 2 * 6000 / 8
    found = t.read_tokens(spark, path).orderBy("start").collect()
    assert [(r.id, r.start, r.n_tokens, r.ids_crc32) for r in found] == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_shards_follow_the_size_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(t, "SHARD_BYTES", 1000)
    path = fresh_path(spark, "tokens")
    docs = spark.range(100).selectExpr("id AS doc_id", "repeat('word ', 40) AS text")
    t.write_tokens(docs, PATH, path)
    assert spark.read.parquet(path).select("shard").distinct().count() >= 15
