import corpus_pipeline
from inkfold.llm import simhash, toxicity
from inkfold.llm.common import table
from tests.llm.helpers import documents, empty, rows
from tests.llm.test_bpe import PATH
from tests.llm.test_decontaminate import brute
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"


def test_stages_in_order(spark, tmp_path):
    """Each stage against its rule on the whole of its input; run() gives what they give one after the other."""
    docs = table(spark, SF, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "token_ids"]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        before, kept = dict(docs.select("doc_id", "text").collect()), {r.doc_id for r in after.collect()}
        if number == 0:
            found = toxicity.score(docs, toxicity.train(docs, table(spark, SF, "labels"))).collect()
            assert kept == {r.id for r in found if r.score < 0.5}
        elif number == 1:
            assert kept == {r.component_id for r in simhash.near_duplicates(docs).collect()}
        else:
            items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
            counts = {i: brute(t, items) for i, t in before.items()}
            assert kept == {i for i, (n, hit, _) in counts.items() if not hit or 20 * hit < n}
        assert after.count() == len(kept) and rows(after) == rows(docs.where(docs.doc_id.isin(list(kept))))
        docs = after
    library = Tokenizer.from_file(PATH)
    want = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in docs.collect()}
    assert {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_odd_rows(spark):
    docs = documents(spark, extra=False).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1L AS n_chars", "'mine' AS ids")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() > 0
        assert stage(spark, docs.where("false"), SF).collect() == []
    assert corpus_pipeline.drop_near_copies(spark, docs, SF).where("doc_id = 3").count() == 1
    assert empty(spark).count() == 0


def test_near_copies_are_rows_not_ids(spark):
    """Clean rows stay whatever their id: null, repeated, or shared with a copy."""
    a, b, c, d, e = ("".join(f"{word}{i} " for i in range(40)) for word in ("ant", "bee", "cat", "dog", "elk"))
    texts = [(3, a), (7, a), (7, b), (5, c), (5, d), (None, e), (None, e), (None, a), (3, a)]
    docs = spark.createDataFrame([(*r, k) for r, k in zip(texts, "xyxyxyyyx", strict=True)], "doc_id LONG, text STRING, lang STRING")
    want = sorted([(3, a, "x"), (7, b, "x"), (5, c, "y"), (5, d, "x")], key=repr)
    for parts in (1, 7):
        kept = rows(corpus_pipeline.drop_near_copies(spark, docs.repartition(parts), SF))
        assert [r for r in kept if r[0] is not None] == want
        alone = [r for r in kept if r[0] is None]
        assert len(alone) == 1 and alone[0][1] == e
        assert alone == rows(corpus_pipeline.drop_near_copies(spark, docs.orderBy("lang", "text"), SF).where("doc_id IS NULL"))
    assert "no id" in {r.text for r in corpus_pipeline.drop_near_copies(spark, documents(spark), SF).collect()}
