"""Run logs and stored states."""

from pyspark.sql import functions as F

from tidemark.sources import runs


def test_runs_are_appended_and_read_back(spark, tmp_path):
    path = str(tmp_path / "runs")
    stats = spark.createDataFrame([("b", "200", 0, None, "payload"), ("a", "404", None, "HTTP 404", "payload")], "id string, status string, items long, error string, body string")
    for n in (2, 1, 3):
        runs.append_run(stats if n != 3 else stats.limit(0), path, F.lit(f"2026-08-0{n}T00:00:00+00:00"), F.lit(f"2026-08-0{n}"))
    (tmp_path / "runs" / "part-broken.json").write_text('\n{"at": \nnot json\n')
    rows = runs.read_runs(spark, path).collect()
    assert [r.day for r in rows] == ["2026-08-01", "2026-08-02", "2026-08-03"] and rows[2].sources == []
    assert [(s.id, s.status, s.items, s.error) for s in rows[0].sources] == [("a", "404", None, "HTTP 404"), ("b", "200", 0, None)]
    assert [(r.day, r.run) for r in runs.read_runs(spark, path, 2).orderBy("run").collect()] == [("2026-08-02", 1), ("2026-08-03", 2)]


def test_an_unreadable_state_is_no_empty_one(spark):
    def read(text):
        return sorted(map(tuple, runs.read_state(spark.createDataFrame([(text,)], "text string")).collect()), key=str)

    assert read('{"a": "1", "b": "x"}') == [("a", "1", True), ("b", "x", True)] and read("{}") == []
    assert read("{broken") == [(None, None, False)] and read(None) == [(None, None, False)]
