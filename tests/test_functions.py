"""Text, dates and numbers on literal expectations and boundaries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text


def values(spark, rows, make, schema="x string"):
    return [r.y for r in spark.createDataFrame([(r,) for r in rows], schema).select(make(F.col("x")).alias("y")).collect()]


def test_fingerprint(spark):
    want = {
        "GPT-5": "openai:gpt:5", "GPT-4o mini": "openai:gpt:4o-mini", "Gemini 2.5 Flash": "google:gemini:2.5-flash", "Claude Opus 4.8": "anthropic:claude:opus:4.8",
        "DeepSeek-V3": "deepseek:v3", "通义 Qwen3 发布": "qwen:3", "Claude 3.5": "anthropic:claude:3.5", "nothing here": None, "": None, None: None, "ＧＰＴ－５": "openai:gpt:5",
    }
    assert values(spark, list(want), lambda c: text.fingerprint(text.fold(c))) == list(want.values())


def test_facet_order(spark):
    want = {"Outage of the release": "incident", "Series B funding": "capital", "New pricing": "pricing", "available in Europe": "distribution", "Benchmark results": "benchmark",
            "Reasoning performance": "capability", "Launch day": "release", "Notes": "update"}
    assert values(spark, list(want), lambda c: text.facet(text.fold(c, True))) == list(want.values())
    assert values(spark, ["update", "benchmark", "capital"], text.facet_bucket) == ["release", "capability", "capital"]


def test_tokens_and_keywords(spark):
    title = "At AI Summit, South Korea Outlines Its AI Future With NVIDIA and Partners"
    assert values(spark, [title], lambda c: text.keywords(text.fold(c)))[0] == ["ai", "summit", "south", "korea", "outlines", "future", "nvidia", "partners"]
    assert sorted(values(spark, ["The update of A-B cd CD"], lambda c: text.title_tokens(text.fold(c)))[0]) == ["cd"]
    assert values(spark, ["", None], lambda c: text.title_tokens(text.fold(c))) == [[], []]


def test_urls(spark):
    want = {
        "HTTPS://www.Example.org/a/b/?utm_source=x&b=2&a=1#frag": "HTTPS://example.org/a/b?a=1&b=2", "http://x.org": "http://x.org/", "http://x.org/?q=": "http://x.org/",
        "http://x.org/p?ref=1": "http://x.org/p",
    }
    assert values(spark, list(want), text.canonical_url) == list(want.values())


def test_markup_and_sections(spark):
    assert values(spark, ["<p>a<script>x<y</script> b<!-- c --></p>\n<style>z</style>d", None], text.strip_tags) == ["a b d", ""]
    assert values(spark, ["intro\n## One\nfirst\n## Two\nsecond\n"], lambda c: text.section(c, "Two")) == ["second"]
    assert values(spark, ["a &amp; b", None], text.unescape) == ["a & b", None]


def test_lifecycle_and_model_ids(spark):
    want = {"Now generally available": "ga", "deprecated": "deprecated", "was shut down": "shutdown", "in beta": "preview", "shut down and deprecated": "ambiguous", "fixes": "unknown", None: "unknown"}
    assert values(spark, list(want), text.lifecycle) == list(want.values())
    assert values(spark, ["Use gpt-5.1-mini, GPT-5.1-mini or claude-opus-4-5; see claude.ai and gpt-docs"], text.model_ids) == [["gpt-5.1-mini", "claude-opus-4-5"]]


def test_authors(spark):
    want = {None: "none", "": "none", "(hidden)": "none", "Ada Lovelace": "person", "By Grace Hopper, Ph.D., Jr.": "person", "octo": "handle", "NVIDIA": "org", "dependabot[bot]": "machine",
            "Research Team": "org", "A B and C D": "multi_person", "ada lovelace": "unknown"}
    assert values(spark, list(want), text.author_kind) == list(want.values())


def test_slug_and_hash(spark):
    assert values(spark, ["Hello, World!", "", "—"], text.slug) == ["hello-world", "untitled", "untitled"]
    assert values(spark, [" abc "], text.content_hash) == ["a9993e364706"]


def test_time_formats(spark):
    utc = dt.datetime(2026, 7, 1, 10, 0)
    texts = ["Wed, 01 Jul 2026 12:00:00 +0200", "1 Jul 2026 10:00:00 GMT", "2026-07-01T10:00:00Z", "2026-07-01T12:00:00+02:00", "2026-07-01 10:00:00", "2026", "soon", "", None, "2026-02-30"]
    assert values(spark, texts, lambda c: dates.parse_any(c).cast("timestamp_ntz")) == [utc] * 5 + [None] * 5


def test_floor_days(spark):
    hours = [0, 23, 24, -1, -24, -25, None]
    want = [0, 0, 1, -1, -1, -2, None]
    start = F.lit("2026-01-10").cast("timestamp")
    assert values(spark, hours, lambda c: dates.floor_days(F.timestamp_add("HOUR", c, start), start), "x int") == want


def test_entry_dates(spark):
    want = {"July 24, 2026": ("2026-07-24", "day", "explicit"), "July 9th, 2024": ("2024-07-09", "day", "explicit"), "June 2026": ("2026-06", "month", "explicit"),
            "Feb 30, 2026": (None, "none", "none"), "July 23": (None, "none", "none"), "no date": (None, "none", "none")}
    assert [tuple(r) for r in values(spark, list(want), dates.entry_date)] == list(want.values())
    assert tuple(values(spark, ["July 23"], lambda c: dates.entry_date(c, F.lit(2025)))[0]) == ("2025-07-23", "day", "section")


def test_rounding_and_scales(spark):
    assert values(spark, [22.5, 12.5, -3.0, 180.0, None], numbers.clamp, "x double") == [22, 12, 0, 100, None]
    assert values(spark, [-1, 0, 80, 800], lambda c: numbers.log_scale(c, 80), "x int") == [0, 0, 1, 1]
    j = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], ["a"]), (None, ["a"])], "a array<string>, b array<string>").select(numbers.jaccard(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in j] == pytest.approx([1 / 3, 0, 0])


def test_display_time(spark):
    assert values(spark, ["2026-01-01T20:30:00Z"], lambda c: dates.display_time(dates.parse_any(c))) == ["2026-01-02 04:30 UTC+8"]


def against_sql(spark, tmp_path, name, table, frame):
    """A query's rows and its SQL's, on a folder that has one table."""
    import duckdb

    from tidemark.plans import catalog

    frame.coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    got = sorted(map(tuple, catalog.queries()[name](spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    return got, sorted(con.execute(catalog.oracle_sql()[name]).fetchall(), key=str)


ODD_PAGES = ["<p>a &amp b &amp;amp; &lt;i&gt; &#39;</p>", "<p>x</p><b cut", "<p>\ue000 \u00a0 \x0b q</p>", None, "", "<scripts>k</scripts><SCRIPT a>n</script>", "a<>b &&copy;; &quot", "<p>" + "&amp" * 100 + "</p>"]


def test_html_strip_is_its_sql_on_odd_pages(spark, tmp_path):
    got, want = against_sql(spark, tmp_path, "q45_html_strip", "pages", spark.createDataFrame(list(enumerate(ODD_PAGES)), "page_id long, html string"))
    assert got == want


def test_visible_text_len_is_its_sql_on_odd_pages(spark, tmp_path):
    # 400 characters as written, 100 if references without a semicolon were decoded
    got, want = against_sql(spark, tmp_path, "q47_visible_text_len", "pages", spark.createDataFrame(list(enumerate(ODD_PAGES)), "page_id long, html string"))
    assert got == want == [("shell", 7), ("thin", 1)]


def test_slug_is_its_sql_on_odd_titles(spark, tmp_path):
    texts = ["Plain title\nbody", "", "\nbody", None, "!!!", "---", "İstanbul İ", "ПриветΣ", "中文 title", "x" * 59 + " -- y", "a" * 80]
    rows = [(n, t, "en", "src1") for n, t in enumerate(texts)]
    got, want = against_sql(spark, tmp_path, "q62_slug", "documents", spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert got == want
