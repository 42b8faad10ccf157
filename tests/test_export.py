"""Events as notes."""

from pyspark.sql import functions as F

from tidemark.sources import export, vault


def test_notes_can_be_read_back(spark, tmp_path):
    schema = "id string, title string, heat int, value int, evidence array<struct<source_id:string,url:string,secret:string>>, body map<string,string>, extra string"
    events = spark.createDataFrame([("e1", 'A "title": x', None, 7, [("s", "u", "no")], {"Facts": "text"}, "x")], schema)
    kept = events.withColumn("evidence", export.evidence_fields(F.col("evidence"), ("source_id", "url")))
    note = export.notes(kept, ("Facts", "Context")).first().note
    assert note == '---\nid: "e1"\ntitle: "A \\"title\\": x"\nheat: null\nvalue: 7\nevidence: [{"source_id":"s","url":"u"}]\n---\n## Facts\ntext\n\n## Context\n\n'
    (tmp_path / "e1.md").write_text(note)
    got = vault.read_notes(spark, f"{tmp_path}/*.md").select(*[vault.front_value(F.col("front"), k).alias(k) for k in ("id", "heat", "value")]).first()
    assert tuple(got) == ("e1", None, "7")


def test_patch_and_watch(spark):
    events = spark.createDataFrame([("a", "old", 1), ("b", "old", 2)], "id string, coverage string, n int")
    got = export.patch(events, spark.createDataFrame([("b", None)], "id string, coverage string"), "coverage").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("a", "old", 1), ("b", None, 2)]
    rows = spark.createDataFrame([("Acme ships",), ("acmes",), ("某公司發布",), (None,)], "t string")
    assert [r.watch_hits for r in export.watch_hits(rows, "t", [("acme", ["Acme"]), ("mou", ["某公司"])]).collect()] == [["acme"], [], ["mou"], []]


def test_only_changed_pages_are_written(spark, tmp_path):
    def pages(*rows):
        return spark.createDataFrame(list(rows), "name string, text string")

    path = str(tmp_path / "store")
    first = pages(("a", "x"), ("b", None), ("c", ""), ("a", "x"))
    assert export.write_changed(first, path) == 3 and export.write_changed(first, path) == 0
    assert export.write_changed(pages(("a", "y"), ("b", ""), ("c", ""), (None, "n")), path) == 3
    assert export.write_changed(pages(("a", "x"), (None, "n")), path) == 1
    assert {r.name: r.text for r in export.latest_pages(spark.read.parquet(path)).collect()} == {"a": "x", "b": "", "c": "", None: "n"}
    assert export.write_changed(pages(), path) == 0 and export.write_changed(pages(), str(tmp_path / "none")) == 0
