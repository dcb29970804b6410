"""Attachments that are files: what is listed, what is opened, and how paths become notes and names."""

import fnmatch
import os
import re
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkfold import EMPTY, DocumentReader, FileStore
from inkfold.functions.names import glob_to_regex
from inkfold.operators.attachments import list_attachments, named_attachment
from inkfold.sources.files import path_glob


def put(root, files):
    for path, data in files.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
    return str(root)


def shut(root, *paths):
    """Puts folders in the place of files that are listed already: their status can be read, they cannot."""
    for path in paths:
        os.remove(root / path)
        os.mkdir(root / path)


def listed(frame):
    return sorted((r.unid, r.att_pos, r.name) for r in frame.collect())


@pytest.fixture
def notes(spark):
    return spark.createDataFrame([(f"U{n}", f"title {n}") for n in range(4)], "unid STRING, title STRING")


FILES = {
    "U0/plan.pdf": b"%PDF 0",
    "U0/SAMPLE.TXT": b"upper",
    "U1/a b+c.txt": b"one",
    "U1/noext": b"two",
    "U2/dir.d/x.txt": b"deeper",
    "U9/z.txt": b"no note",
    "top.txt": b"not an attachment",
}


def test_paths_become_notes_and_names(spark, tmp_path, notes):
    store = FileStore(put(tmp_path / "in", FILES), "in/{unid}/{name}")
    assert listed(store.attachments(spark)) == [("U0", 0, "SAMPLE.TXT"), ("U0", 0, "plan.pdf"), ("U1", 0, "a b+c.txt"), ("U1", 0, "noext"), ("U9", 0, "z.txt")]
    made = DocumentReader(EMPTY.with_string("title")).notes(notes).attachments(store)
    assert sorted((r.unid, r.attachment_name, r.text, r.meta_title) for r in made.load().collect()) == [
        ("U0", "SAMPLE.TXT", "upper", "title 0"), ("U0", "plan.pdf", "%PDF 0", "title 0"), ("U1", "a b+c.txt", "one", "title 1"),
    ]
    assert [r.text for r in made.pattern("sample.*").load().collect()] == ["upper"]
    named = named_attachment(notes.where("unid = 'U0'"), store.attachments(spark), "plan.pdf")
    assert [bytes(r.content) for r in named.collect()] == [b"%PDF 0"]


def test_listing_opens_no_file_and_a_glob_only_its_own(spark, tmp_path, notes, plan_of):
    root = tmp_path / "in"
    for layout in ("{unid}/{name}", None):
        paths = [f"U{n}/f{n}.{'pdf' if n < 2 else 'txt'}" for n in range(4)]
        if layout is None:
            root = tmp_path / "named"
            paths = [f"unid=U{n}/att_pos=3/name=f{n}.{'pdf' if n < 2 else 'txt'}/part-0" for n in range(4)]
        put(root, {path: b"text" for path in paths})
        store = FileStore(str(root), layout)
        all_names, pdfs = store.attachments(spark), DocumentReader(EMPTY).notes(notes).attachments(store).pattern("*.PDF").load()
        assert all_names.count() == pdfs.count() + 2 == 4
        few = DocumentReader(EMPTY).notes(notes.where("unid = 'U3'")).attachments(store).load()
        shut(root, *paths[2:])
        assert sorted(r.text for r in pdfs.collect()) == ["text", "text"]
        shut(root, *paths[:2])
        names = list_attachments(notes, all_names)
        assert [r.name for r in names.orderBy("name").collect()] == ["f0.pdf", "f1.pdf", "f2.txt", "f3.txt"]
        assert "content" not in "".join(re.findall(r"ReadSchema: struct<([^>]*)", plan_of(names)))
        with pytest.raises(Exception):  # noqa: B017
            pdfs.collect()
    assert "PartitionFilters: [" in plan_of(pdfs) and "rlike" in plan_of(pdfs, "simple").lower()
    # A few notes prune folders too.
    assert re.search(r"PartitionFilters: \[[^\n]*\(unid#\d+ = U3\)", plan_of(few))


def test_lengths_and_times_bound_files_unopened(spark, tmp_path, plan_of):
    root = tmp_path / "in"
    paths = [f"U{n}/f.txt" for n in range(5)]
    put(root, {path: b"x" * (10 * n) for n, path in enumerate(paths)})
    for n, path in enumerate(paths):
        at = datetime(2024, 1, 1 + n).timestamp()
        os.utime(root / path, (at, at))
    store = FileStore(str(root), least_bytes=10, most_bytes=30, changed_from=datetime(2024, 1, 3), changed_before=datetime(2024, 1, 4))
    found = store.attachments(spark)
    assert [(r.unid, r.length, bytes(r.content)) for r in found.collect()] == [("U2", 20, b"x" * 20)]
    plan = plan_of(found)
    for pushed in ("GreaterThanOrEqual(length,10)", "LessThanOrEqual(length,30)", "LessThan(modificationTime", "GreaterThanOrEqual(modificationTime"):
        assert pushed in plan
    found = FileStore(str(root), most_bytes=30).attachments(spark)
    assert found.count() == 3  # an empty file is none
    os.chmod(root / paths[4], 0)
    assert sorted(len(r.content) for r in found.collect()) == [10, 20, 30]


def test_positions_digits_and_odd_names(spark, tmp_path, notes):
    """Numbers in keys keep their zeros; names may begin with a dot, hold spaces, percent signs or line breaks."""
    odd = ["_x.txt", ".hidden.txt", "50%.txt", "a\nb.txt", "ü {1},[2].txt"]
    store = FileStore(put(tmp_path / "in", {f"0007/{n}-{name}": b"text" for n, name in enumerate(odd)}), "{unid}/{pos}-{name}")
    assert listed(store.attachments(spark)) == [("0007", n, name) for n, name in enumerate(odd)]
    assert [r.name for r in store.attachments(spark, "*{1}*,\\[2\\].TXT".replace("{1}", "\\{1\\}")).collect()] == [odd[4]]
    rows = [("0007", n, name, "text") for n, name in enumerate(odd[2:])]
    spark.createDataFrame(rows, "unid STRING, att_pos INT, name STRING, value STRING").write.partitionBy("unid", "att_pos", "name").text(str(tmp_path / "named"))
    store = FileStore(str(tmp_path / "named"), None)
    assert listed(store.attachments(spark)) == [row[:3] for row in rows]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_stores_that_cannot_be(spark, tmp_path):
    for layout in ("{name}", "{unid}", "{unid}/{unid}/{name}", "{unid}/{name}/{size}", ""):
        with pytest.raises(ValueError, match="layout"):
            FileStore("x", layout)
    with pytest.raises(ValueError, match="path"):
        FileStore("")
    with pytest.raises(ValueError, match="not named"):
        FileStore(put(tmp_path / "in", FILES), None).attachments(spark)
    with pytest.raises(ValueError, match="glob"):
        FileStore(str(tmp_path / "in")).attachments(spark, "{a,{b}}")
    (tmp_path / "none").mkdir()
    for layout in ("{unid}/{name}", None):
        none = FileStore(str(tmp_path / "none"), layout).attachments(spark)
        assert none.collect() == [] and {"unid", "att_pos", "name", "length", "modified", "content"} == set(none.columns)


def as_regex(glob):
    """A file system's glob as a regex: braces are alternatives, the rest is as in the standard library."""
    out = []
    for piece in re.split(r"([{},])", glob):
        out.append({"{": "(?:", "}": ")", ",": "|"}.get(piece) or (fnmatch.translate(piece).removeprefix("(?s:").removesuffix(r")\Z").removesuffix(r")\z") if piece else ""))
    return "(?s)" + "".join(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "K", "i", "*", "?", "**", "[a-c]", "[!x]", "{a,ik}", "{,l}", ".", "é", "\\*", "\\{", "1", " ", "^", "$"]), max_size=7), st.text("aAkKKiİİé.*{}1l ^$xb", max_size=7))
def test_path_globs_let_every_match_through(pieces, name):
    glob = "".join(pieces)
    if re.match(glob_to_regex(glob.lower() or "*.*").replace(r"\z", r"\Z"), name.lower()):
        assert re.fullmatch(as_regex(path_glob(glob)), name), (glob, path_glob(glob))
