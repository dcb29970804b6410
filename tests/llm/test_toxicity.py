import zlib

import numpy as np
from pyspark.sql import functions as F

from inkfold.llm import toxicity
from inkfold.llm.queries import QUERIES
from tests.llm.helpers import documents, empty, rows

SF = "/root/testdata/sf0.01"


def machine(place, n):
    rng = np.random.default_rng(1)
    size = n + toxicity._LENGTHS
    return toxicity.Machine(place, 0.3, rng.normal(size=size), rng.normal(size=(size, 3)))


def test_margins_are_those_of_all_pairs():
    place = np.full(2 * toxicity._HALF, -1, np.int32)
    terms = np.unique(toxicity.text_terms("you stupid clowns, stupid")[0])
    place[toxicity.present(np.concatenate((terms, terms)))] = np.arange(2 * len(terms))
    model = machine(place, 2 * len(terms))
    for text in ("You stupid clowns", "stupid stupid", "nothing known", "", None):
        active = model.active(text)
        want = model.bias + model.weights[active].sum()
        want += sum(model.factors[a] @ model.factors[b] for i, a in enumerate(active) for b in active[:i])
        assert np.isclose(model.margins(active, np.array([0]))[0], want)


def test_pairs_are_learnt():
    """The label is true for just those texts that hold both terms, which no sum of weights can tell from noise alone."""
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for _ in range(1200):
        a, b = rng.integers(0, 2, 2)
        texts.append(np.array([*([0] * a), *([1] * b), 2 + rng.integers(5)], np.int32))
        labels.append(float(a == b))
    got = toxicity.fit(texts, np.array(labels), np.zeros(1, np.int32), 7)
    scores = toxicity._sigmoid(got.margins(np.concatenate(texts), np.concatenate(([0], np.cumsum([len(x) for x in texts])[:-1]))))
    assert ((scores >= 0.5) == np.array(labels)).mean() > 0.99


def test_odd_texts_and_tables(spark):
    docs = documents(spark)
    labels = spark.sql("SELECT 4L AS doc_id, 1 AS toxic UNION ALL SELECT 4L, 0 UNION ALL SELECT 3L, 0 UNION ALL SELECT NULL, 1 UNION ALL SELECT 8L, NULL")
    for given in (labels, labels.where("false"), labels.where("toxic = 0")):
        model = toxicity.train(docs, given)
        found = toxicity.score(docs, model).collect()
        assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
        kept = toxicity.keep_clean(docs, model)
        assert kept.schema == docs.schema
        clean = sorted(str(r.id) for r in found if r.score < 0.5)
        assert sorted(str(r.doc_id) for r in kept.collect()) == clean
        assert toxicity.score(empty(spark), model).collect() == []
    assert toxicity.train(empty(spark), labels).bias < 0


def test_held_out_accuracy(spark):
    found = QUERIES["op4_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = found.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.92
    assert found.count() == 1000


def test_scores_do_not_see_ids_or_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    other = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    a, b = rows(toxicity.score(docs, model)), rows(toxicity.score(other, model))
    assert dict(a) == {i - 7: s for i, s in b}
