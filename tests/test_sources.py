"""Files, feeds and streams."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.plans import catalog
from tidemark.sources import pages, vault
from tidemark.streaming import state

SMALL = "/root/testdata/sf0.001"
ROW = {"title": "t", "summary": "", "url": "http://x/1", "url_canonical": "http://x/1", "source_id": "s1", "first_observed_at": "2026-07-01T00:00:00Z", "is_new": True, "backfill": False}


@pytest.fixture
def folder(tmp_path):
    def put(day, source, lines):
        p = tmp_path / "_corpus" / day
        p.mkdir(parents=True, exist_ok=True)
        (p / f"{source}.jsonl").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")

    put("2026-07-01", "s1", [ROW, "", "{broken", ROW | {"url": "http://x/2", "url_canonical": "http://x/2"}])
    put("2026-07-02", "s1", [ROW | {"summary": "late text", "first_observed_at": "2026-07-02T00:00:00Z"}, ROW | {"url": None, "url_canonical": None}])
    put("notes", "s1", [ROW])
    return str(tmp_path)


def test_corpus(spark, folder):
    rows = vault.read_corpus(spark, folder)
    assert rows.count() == 4 and vault.latest_day(rows).count() == 2 and vault.distinct_items(rows).count() == 3
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        vault.read_corpus(spark, folder, strict=True).collect()
    first = {r.url: (r.first_observed_at, r.summary) for r in vault.first_by_url(rows).collect()}
    assert first == {"http://x/1": ("2026-07-01T00:00:00Z", "late text"), "http://x/2": ("2026-07-01T00:00:00Z", None)}
    assert [(r.items, str(r.last_day)) for r in vault.observed(rows).collect()] == [(3, "2026-07-02")]


def test_sticky_flags_and_day_overwrite(spark, tmp_path):
    schema = "source_id string, url_canonical string, is_new boolean, backfill boolean, day string"
    before = spark.createDataFrame([("s", "u", True, False, "d1")], schema)
    now = spark.createDataFrame([("s", "u", False, True, "d1"), ("s", "v", True, True, "d1")], schema)
    merged = vault.carry_day_flags(now, before)
    assert {(r.url_canonical, r.is_new, r.backfill) for r in merged.collect()} == {("u", True, False), ("v", True, True)}
    path = str(tmp_path / "days")
    vault.write_day(before.unionByName(spark.createDataFrame([("s", "w", True, True, "d0")], schema)), path)
    vault.write_day(merged, path)
    assert {(r.day, r.url_canonical) for r in spark.read.parquet(path).collect()} == {("d0", "w"), ("d1", "u"), ("d1", "v")}


def test_ledger_round_trip(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([("t", "1", "f", None, "b", "r")], "at string, id string, field string, from string, to string, reason string")
    assert not vault.append_ledger(rows.limit(0), path) and not (tmp_path / "ledger").exists()
    assert vault.append_ledger(rows, path)
    (tmp_path / "ledger" / "extra.txt").write_text('{"id": "2"}\nnot json\n')
    assert [(r.id, r["from"], r.to) for r in vault.read_ledger(spark, path).collect()] == [("1", None, "b")]


def test_notes(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\nid: 'x'\nheat: null\n---\nbody\n## H\ntext\n")
    (tmp_path / "b.md").write_text("no front matter")
    rows = vault.read_notes(spark, f"{tmp_path}/*.md").select(vault.front_value(F.col("front"), "id").alias("id"), vault.front_value(F.col("front"), "heat").alias("heat"), "body").orderBy("body").collect()
    assert [(r.id, r.heat) for r in rows] == [("x", None), (None, None)] and rows[1].body == "no front matter"


RSS = """<rss><channel><item><title>A &amp;amp; B</title><description>&lt;p&gt;x&lt;/p&gt;</description><guid>http://g/1</guid><pubDate>Wed, 01 Jul 2026 12:00:00 GMT</pubDate></item>
<item><title>C</title><link>http://l/2</link></item><item><title>D</title></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><link href="http://a/1"/><updated>2026-07-01</updated><author><name>N</name></author></entry></feed>"""


def test_feeds(spark):
    got = pages.items_of(spark.createDataFrame([("r", RSS), ("a", ATOM), ("bad", "<x"), ("none", None)], "source_id string, body string"), lambda b: pages.read_feed(b, 2)).collect()
    assert sorted((r.source_id, r.pos, r.title, r.url, r.author) for r in got) == [("a", 0, "E", "http://a/1", "N"), ("r", 0, "A & B", "http://g/1", None), ("r", 1, "C", "http://l/2", None)]


def test_sitemap_json_and_release_pages(spark):
    xml = "<urlset><url><loc>http://x/blog/opus-4-5-is-here</loc><lastmod>2026-01-01</lastmod></url><url><loc>http://x/blog/b</loc><lastmod>2026-02-01</lastmod></url><url><loc>http://x/other</loc></url></urlset>"
    assert [(r["title"], r["published"]) for r in pages.read_sitemap(xml, 5, "http://x/blog")] == [("B", "2026-02-01"), ("Opus 4.5 Is Here", "2026-01-01")]
    body = json.dumps({"d": {"items": [{"n": "T", "at": 0, "id": 7}, {"n": "U", "link": "http://u"}]}})
    got = pages.read_json_api(body, 5, "d.items", {"title": "n", "published": "at", "url": "link"}, "http://f/{id}")
    assert [(r["title"], r["url"], r["published"]) for r in got] == [("T", "http://f/7", "1970-01-01T00:00:00+00:00"), ("U", "http://u", None)]
    html = '<h3><div id="july-24-2026">x</div></h3><ul><li>gpt-5.1 is <b>generally available</b></li></ul><h3 id="july-9th-2024">y</h3><ul><li>old model deprecated</li></ul>'
    rows = pages.release_notes(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("part", "pos").collect()
    assert [(r.date, r.lifecycle, r.tail) for r in rows] == [("2026-07-24", "ga", False), ("2024-07-09", "deprecated", True)] and rows[0].model_ids == ["gpt-5.1"]
    html = '<h3 id="sept-3-2026">x</h3><link href="a"><nav><ul><li>Home</li></ul></nav><li>One entry</li><li>July 23, 2026</li><li> </li><h3 id="May-4-2026">y</h3><lite>no</lite><aside><li>z</li></aside><footer><li>Terms</li></footer>'
    rows = pages.release_notes(spark.createDataFrame([(1, html), (2, None), (3, "<p id='x'>")], "page_id long, html string")).collect()
    assert [(r.page_id, r.date, r.text) for r in rows] == [(1, "2026-09-03", "One entry")]


def test_fetch_verdicts(spark):
    rows = [(None, None, None, "unreachable"), (404, None, None, "no_robots"), (403, None, None, "unavailable_403"), (500, None, None, "error"), (200, "html", None, "not_robots"), (200, "robots", True, "ok"), (200, "robots", False, "disallow")]
    df = spark.createDataFrame(rows, "s int, k string, a boolean, want string")
    assert all(r.x == r.want for r in df.select("want", pages.robots_reason(F.col("s"), F.col("k"), F.col("a")).alias("x")).collect())


def test_merged_state_is_repeatable(spark, tmp_path):
    def least(batch, before):
        both = batch if before is None else batch.unionByName(before)
        return both.groupBy("k").agg(F.min("v").alias("v"))

    path = str(tmp_path / "s")
    batches = [spark.createDataFrame(x, "k string, v int") for x in ([("a", 3), ("b", 1)], [("a", 2)], [("a", 2)], [("c", 0)])]

    def dies(number):
        raise RuntimeError

    shown = lambda: {(r.k, r.v) for r in state.current(spark, path).collect()}
    assert state.current(spark, path) is None
    sink = state.merge_into(path, ["k"], least, "one")
    sink(batches[0], 0)
    with pytest.raises(RuntimeError):
        state.merge_into(path, ["k"], least, "one", dies)(batches[1], 1)
    assert shown() == {("a", 3), ("b", 1)}
    sink(batches[1], 1)
    sink(batches[3], 1)
    assert shown() == {("a", 2), ("b", 1)}
    state.merge_into(path, ["k"], least, "two")(batches[3], 1)
    assert shown() == {("a", 2), ("b", 1), ("c", 0)}


@pytest.fixture(scope="module")
def duck():
    import os

    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{f}'")
    return c


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v.isoformat()[:19] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_against_its_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in catalog.oracle_sql():
        assert name in ("q15_leader_cluster", "q60_entity_match")
        return
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[k]) for k in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
