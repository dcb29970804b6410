"""The files of pages: written by tasks as Spark would write them."""

from workload import notes as workload_notes

ODD = ["930.html", "a b+c.TXT", "50%.txt", "%41", "a\nb", "ü {1},[2]=^'\"#?*:\\.txt", "x" * 60, "", None]


def test_folders_are_named_as_spark_names_them(spark, tmp_path):
    rows = [(unid, name, text) for unid in ("U0", "U 1%", "", None) for name in ODD for text in ("one", None, "one")]
    frame = spark.createDataFrame(rows, "unid STRING, name STRING, content STRING").coalesce(1)
    workload_notes.put_files(frame, str(tmp_path / "own"))
    frame.write.partitionBy("unid", "name").text(str(tmp_path / "spark"))
    tree = {}
    for kind in ("own", "spark"):
        found = [p for p in (tmp_path / kind).rglob("part-*") if p.is_file()]
        tree[kind] = sorted((str(p.parent.relative_to(tmp_path / kind)), sorted(p.read_bytes().split(b"\n"))) for p in found)
    assert tree["own"] == tree["spark"] and len(tree["own"]) == 3 * (len(ODD) - 1)
