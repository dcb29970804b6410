"""A corpus pipeline over documents: toxic texts out, one of each group of near copies, no benchmark texts, token ids.

Every stage takes (spark, docs, sf_dir), keeps the columns of docs and returns the rows that it lets through; the last one
returns token ids. run() writes each stage's rows as Parquet into the shared folder and reads them again for the next, so
that a lost executor costs no more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.llm import bpe, decontaminate, simhash, toxicity
from inkfold.llm.common import bound_batches, fresh_path, table
from inkfold.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on the labels that are not held out, does not find toxic.

    A document with a null doc_id is judged by its text like any other.
    """
    bound_batches(spark)
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, machine)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row, that with the least doc_id. Rows of one doc_id, or without any, are judged by their texts."""
    bound_batches(spark)
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than 5 percent of whose words lie in windows of benchmark items."""
    bound_batches(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and their number, and the text that the ids decode to."""
    bound_batches(spark)
    path = tokenizer_path("word_bpe_49k.json")
    made = bpe.decode(bpe.encode(docs, path), path)
    return made.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("text").alias("decoded"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("token_ids", token_ids),
]

#: No SQL: the factorization machine is fitted, and the links and merges are beyond it. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
