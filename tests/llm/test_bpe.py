import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from inkfold.llm import bpe
from inkfold.llm.queries import QUERIES, tokenizer_path
from tests.llm.helpers import SF, documents, empty

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_against_the_library(library):
    own, rng = bpe.WordBpe(PATH), random.Random(5)
    letters = "abcdeé ü'́ΣßİK9<|>\n\t\x1c\x85\xa0中文!?.,_²½ª"
    cases = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    cases += ["", "<|startoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|>", "x" * 500, "thethe" * 60, "'s'S it's", "ΑΣ", "é" * 30]
    for text in cases:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, text
        assert own.decode(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False), text


def test_the_rank_array_and_the_heap_agree():
    own, rng = bpe.WordBpe(PATH), random.Random(6)
    for _ in range(300):
        parts = [rng.choice("thean") for _ in range(rng.randint(1, 60))]
        parts[-1] += own.end
        assert own._scan(list(parts)) == own._heap(list(parts))


def test_frames(spark, library):
    docs = documents(spark)
    found = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(found) == docs.count()
    want = sorted((str(r.doc_id), library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    assert sorted((str(r.id), list(r.ids)) for r in found) == want
    assert bpe.encode(empty(spark), PATH).collect() == []
    odd = bpe.decode(spark.sql("SELECT 1L AS id, CAST(NULL AS ARRAY<INT>) AS ids UNION ALL SELECT 2L, array(-1, 320, 99999)"), PATH)
    assert dict((r.id, r.text) for r in odd.collect()) == {1: "", 2: library.id_to_token(320)}


def test_query(spark, library):
    got = {r.doc_id: tuple(r) for r in QUERIES["op10_bpe"](spark, SF).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id] == (r.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(text))
