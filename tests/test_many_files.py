"""Stores of many folders and files: listed without a quadratic search for columns, scanned by few tasks."""

import re

import pytest
from pyspark.sql import functions as F

from inkfold import FileStore
from inkfold.sources import files
from tests.test_files import put, shut

ODD = ["930.html", "a b+c.TXT", "50%.txt", "%41", "a\nb", "ü {1},[2]=^'\"#?*:\\.txt", "x" * 60, "", None]


def test_many_folders_give_the_same_columns(spark, tmp_path, monkeypatch, plan_of):
    rows = [("0007", 3, name, "text") for name in ODD] + [(None, 2, "f.pdf", "pdf"), ("U+1", 0, "f.pdf", "more")]
    spark.createDataFrame(rows, "unid STRING, att_pos INT, name STRING, value STRING").write.partitionBy("unid", "att_pos", "name").text(str(tmp_path / "in"))
    store = FileStore(str(tmp_path / "in"), None)
    by_spark = store.attachments(spark)
    monkeypatch.setattr(files, "PARSED_FOLDERS", 3)
    by_path = store.attachments(spark)
    columns = [c for c in by_path.columns if c != "modified"]
    assert by_path.dtypes == by_spark.dtypes and "unid#" not in re.search(r"PartitionFilters: [^\n]*|$", plan_of(by_path)).group()
    as_rows = lambda frame: sorted(map(repr, frame.select(columns).collect()))
    assert as_rows(by_path) == as_rows(by_spark)  # an empty name is written as none
    assert as_rows(by_path.where("length < 5")) == as_rows(by_spark.where("length < 5"))


def test_many_folders_are_pruned_before_files_are_opened(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PARSED_FOLDERS", 3)
    paths = [f"unid=U{n}/name=f{n}.{'pdf' if n < 2 else 'txt'}/part-0" for n in range(6)]
    root = tmp_path / "in"
    put(root, {path: b"text" for path in paths})
    store = FileStore(str(root), None)
    pdfs, few = store.attachments(spark, "*.PDF"), store.attachments(spark).where(F.col("unid").isin("U0", "U1"))
    names = store.attachments(spark)
    shut(root, *paths[2:])
    assert [bytes(r.content) for r in pdfs.collect()] == [bytes(r.content) for r in few.collect()] == [b"text"] * 2
    assert names.select("name").distinct().count() == 6
    put(tmp_path / "other", {f"U{n}/f.txt": b"text" for n in range(5)})
    with pytest.raises(ValueError, match="not named"):
        FileStore(str(tmp_path / "other"), None).attachments(spark)


def test_small_files_share_tasks(spark, tmp_path):
    put(tmp_path / "in", {f"U{n}/f.txt": b"text" for n in range(400)})
    assert FileStore(str(tmp_path / "in")).attachments(spark).select("name").rdd.getNumPartitions() <= 9
