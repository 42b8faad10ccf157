"""Rules on handed-in texts."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import editing


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "x string").select(make(F.col("x")).alias("y")).first().y


def test_wording(spark):
    assert one(spark, "这个視頻的質量,version 3.2很好...見 http://a.b/c,d (x)", editing.clean_wording) == "这个影片的品質，version 3.2很好⋯⋯見 http://a.b/c,d (x)"
    assert one(spark, "短視頻與人工智能", editing.wording_changes) == ["人工智能", "短視頻"]
    assert one(spark, None, editing.clean_wording) is None


def test_translation(spark):
    cases = {"": "blank", "only English": "untranslated", "太長" * 20: "too_long", "賦能產業": "banned:賦能", "好的。": None}
    for text, want in cases.items():
        got = one(spark, text, lambda c: editing.translation(c, 20, ("賦能",), F.lit(True)))
        assert got.reject == want
    assert one(spark, "好的。", lambda c: editing.translation(c, 20, (), F.lit(False))) == ("好的", "no_source")


def test_headings(spark):
    for text in ("## 事實\n內容", "## 事實：\n## 事實\n內容", "### 事實：內容", "  內容"):
        assert one(spark, text, lambda c: editing.strip_own_heading(c, "事實")) == "內容"
    assert one(spark, "## 其他\n內容", lambda c: editing.strip_own_heading(c, "事實")) == "## 其他\n內容"


def test_companies(spark):
    df = spark.createDataFrame([(["gemini", "acme"],), (["gemini"],), (["torch"],), (None,)], "h array<string>")
    names, kinds, owners = {"acme": "Acme", "deep": "Deep", "gemini": "Gemini"}, {"acme": "company", "deep": "company", "gemini": "product", "torch": "framework"}, {"gemini": "deep"}
    assert [r.c for r in df.select(editing.infer_company(F.col("h"), names, kinds, owners).alias("c")).collect()] == ["Acme", "Deep", "industry", "industry"]


def test_heat_claims(spark):
    assert one(spark, "heat 達到 87 分, heat 未量測 3, heat is high, heat 9", lambda c: editing.heat_claims(c, "heat")) == ["heat 達到 87 分, he", "heat 9"]


def test_candidates(spark):
    got = editing.harvest(spark.createDataFrame([("The Foo Bar met Acme Labs and 「某產品」, Foo Bar again.",), (None,)], "t string"), "t", [("a", "acme", "company"), ("b", "foo bar baz", "model")]).collect()
    assert sorted((r.candidates for r in got), reverse=True) == [["The Foo Bar", "Foo Bar", "某產品"], []]


def test_versions(spark):
    df = spark.createDataFrame([("Claude Opus 4.5 and claude opus V4.5; Claude Opus 4.5-2; Xclaude Opus 3",)], "t string")
    got = editing.derive_versions(df, "t", [("claude", ["Claude"], r"\s+(opus)\s+(v?\d+(?:\.\d+)?)")]).first()
    assert got.derived_entities == ["claude@opus-4.5", "claude@opus-v4.5"]
    lines = [("qwen", ["通義千問", "Q.wen"], r"\s*(v?\d+(?:\.\d+)?)(?:\s*(max|plus))?"), ("plain", ["Plain"], ""), ("cmd", ["cmd"], r" (a|\d)")]
    df = spark.createDataFrame([(1, "發布通義千問 V3 Max, q.wen2.5 and Qxwen 7, cmd a, CMD 7"), (2, None)], "k int, t string")
    got = {r.k: r.derived_entities for r in editing.derive_versions(df, "t", lines).collect()}
    assert got == {1: ["qwen@3-max", "qwen@2.5", "cmd@7"], 2: []}
    assert editing.derive_versions(df, "t", []).first().derived_entities == []


def test_chains_and_robots(spark):
    day = dt.date(2026, 7, 10)
    rows = [(day, True, "ok", False), (dt.date(2026, 7, 1), True, "stale", True), (dt.date(2026, 7, 11), True, "future", True), (None, True, "never", True), (day, False, "unmeasurable", False)]
    df = spark.createDataFrame(rows, "d date, m boolean, code string, alert boolean").withColumn("x", editing.chain_alert(F.col("d"), F.lit(day), 3, F.col("m")))
    assert all((r.x.code, r.x.alert) == (r.code, r.alert) for r in df.collect())
    rows = [(True, "ok", 9, "unchanged"), (False, "no_robots", 9, "opened"), (None, "ok", 9, "opened"), (True, "disallow", 9, "closed"), (False, "disallow", 9, "unchanged"), (True, "error", 9, "unknown_keep"), (True, "disallow", 2, "skip")]
    df = spark.createDataFrame(rows, "b boolean, r string, d int, want string").withColumn("x", editing.robots_change(F.col("b"), F.col("r"), F.col("d"), 7))
    assert all(r.x == r.want for r in df.collect())


def test_sticky_days_and_crons(spark):
    df = spark.createDataFrame([("k", 1, 0), ("k", 2, 5), ("k", 3, 0)], "k string, day int, n int")
    assert [r.last_day for r in editing.sticky_last(df, "k", "day", F.col("n") > 0).orderBy("day").collect()] == [None, 2, 2]
    text = 'on:\n  schedule:\n    - cron: "0 16 * * *"  # 00:00 here\n    - cron: \'0 */2 * * *\'\n'
    got = editing.cron_entries(spark.createDataFrame([(1, text)], "id int, t string"), "t").collect()
    assert [(r.expr, r.comment, r.daily_hour) for r in got] == [("0 16 * * *", "# 00:00 here", 16), ("0 */2 * * *", "", None)]
