"""Registries, roll-ups, references and files of streams on boundaries and against plain forms."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import editing, entities, registries, rollups
from tidemark.sources import pages

RAW = {
    "feeds": [{"id": "a", "track": "official", "tier": 1, "role": "primary"}, {"id": "x-<slug>", "tier": 2}, {"id": ""}, {"id": "b", "tier": "two", "lifecycle": "dormant"}],
    "pages": [{"id": "a", "track": "media", "tier": "2"}],
}


def values(spark, rows, make):
    return [r.x for r in spark.createDataFrame([(n, t) for n, t in enumerate(rows)], "n int, t string").orderBy("n").select("n", make(F.col("t")).alias("x")).collect()]


def test_registry_rows(spark):
    rows = {r.id: r for r in registries.sources(spark, RAW, ("feeds", "pages")).collect()}
    assert set(rows) == {"a", "b"} and (rows["a"].section, rows["a"].tier, rows["b"].tier) == ("pages", 2, None)
    assert {r.id for r in registries.sources(spark, RAW, ("feeds",), skip_templates=False).collect()} == {"a", "b", "x-<slug>"}
    assert registries.dictionary({"policies": [{"id": "p", "canonical": "P", "aliases": ["Q"], "term_type": "t"}], "companies": [{"id": "c", "canonical": "C", "term_type": "k"}]}) == [("c", "C", "k"), ("p", "P", "t"), ("p", "Q", "t")]


def test_what_a_missing_source_leaves(spark):
    registry = registries.sources(spark, RAW, ("feeds", "pages"))
    s = spark.createDataFrame([(1, "a", "own", 9), (2, "b", "own", 9), (3, "zz", "own", 9), (4, None, None, None)], "k int, source_id string, track string, tier int")
    got = {r.k: (r.state, r.track, r.tier, r.role) for r in registries.with_sources(s, registry).collect()}
    assert got == {1: ("known", "media", 2, None), 2: ("dormant", None, None, None), 3: ("missing", "own", 9, None), 4: ("missing", None, None, None)}
    told = {r.source_id: (r.tier, r.primary) for r in registries.evidence_tiers(s.select("source_id"), registries.sources(spark, RAW, ("feeds",))).collect()}
    assert told == {"a": (1, True), "b": (3, False), "zz": (3, False), None: (3, False)}


def test_days_and_names(spark):
    assert values(spark, ["2026-08-01", "2026-13-99", "2026-W30-1", "2026-8-01", None, "notes"], registries.is_day) == [True, False, False, False, False, False]
    lines = spark.createDataFrame([("2026-08-02", " "), ("2026-08-01", "x"), ("2026-08-01", ""), ("tmp", "x")], "day string, line string")
    assert [r.day for r in registries.filled_days(lines).collect()] == ["2026-08-01"]
    assert values(spark, ["src-hn", "openai_blog", None, "-"], registries.source_name) == ["Hacker News", "OpenAI Blog", "來源", "來源"]
    assert values(spark, [' a/b:c ', "", None], registries.file_name) == ["a-b-c", "unnamed", "unnamed"]
    assert values(spark, ["<a href=\"x\">R&D's</a>", None], registries.escaped) == ["&lt;a href=&quot;x&quot;&gt;R&amp;D&#x27;s&lt;/a&gt;", ""]
    assert values(spark, ["x TODO", "待補充", "done", None], registries.has_placeholder) == [True, True, False, False]


def test_titles_from_addresses():
    want = {
        "https://x.org/news/claude-opus-4-5": "Claude Opus 4.5", "https://x.org/a/2026-08-03": "2026 08 03", "https://x.org/GPT_4o-mini.html?x=1": "GPT 4o Mini",
        "https://x.org/a-1-2-3-4/": "A 1.2 3 4", "https://x.org/post-123000637-5": "Post 123000637 5", "https://x.org/": "",
        "https://x.org/4-5-model-4-5": "4 5 Model 4.5", "https://x.org/a-1-b-2-3-_c": "A 1 B 2.3 C", "https://x.org/--": "",
    }
    assert {u: pages.slug_title(u) for u in want} == want


def test_visible_text(spark):
    rows = ["<p>We&#x27;ve launched&nbsp;R&amp;D</p>", "a  b <div class=\"cut", "1 <> 2", None, "<style>x</style>"]
    assert values(spark, rows, text.strip_tags) == ["We've launched R&D", "a b", "1 <> 2", "", ""]
    assert values(spark, ["<li>a&lt;b</li>|<li></li>|c", ""], lambda t: text.strip_all(F.split(t, r"\|"))) == [["a<b", "", "c"], [""]]


def test_author_kinds_at_the_end_of_names(spark):
    want = {
        "Press Smith": "person", "Jane Labs Doe": "person", "NVIDIA Community": "org", "Steering Committee.": "org", "dependabot": "machine", "release_bot": "machine", "newsbot": "handle",
        "A. Robot": "person", "x [bot]": "machine", "Ann Lee et al": "multi_person", "IBM": "org", "IB": "handle", "By: Ann Lee, PhD, Jr.": "person", "Ann (hidden) (guest)": "handle", "(hidden)": "none", "ann lee": "unknown",
    }
    assert values(spark, list(want), text.author_kind) == list(want.values())


def _plain_hits(t, dictionary):
    t = entities.fold(t)
    taken, out = [], []
    for n, (entity, surface, _) in sorted(enumerate(dictionary), key=lambda x: (-len(entities.fold(x[1][1])), x[0])):
        word = entities.fold(surface)
        at = t.find(word)
        around = t[at - 1 : at] + t[at + len(word) : at + len(word) + 1]
        if at >= 0 and all(at >= j or at + len(word) <= i for i, j in taken) and not (word.isascii() and any(c.isalnum() for c in around)):
            taken.append((at, at + len(word)))
            out.append((at, entity))
    return list(dict.fromkeys(e for _, e in sorted(out)))


def test_entities_against_a_plain_loop(spark):
    words = [("ray", "Ray", "tool"), ("arr", "Array Tools", "company"), ("ai", "AI", "tech"), ("oai", "Open AI", "company"), ("han", "通义", "line"), ("x", "Ray", "other"), ("e", "É​cole", "school")]
    texts = ["Array tools and ray", "ray, array", "Open AI and AI", "AI at Open AI", "通义x通义", "École", "rays ray", "the ＡＩ‏ now", "", None, "openai"]
    got = entities.match_entities(spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string"), "t", words).orderBy("n").collect()
    assert [r.entity_hits for r in got] == [_plain_hits(t, words) for t in texts]
    assert got[0].entity_types == ["company"] and got[0].entity_surfaces == ["array tools"] and entities.match_entities(spark.range(1).selectExpr("'a' as t"), "t", []).first().entity_hits == []


def test_random_texts_against_a_plain_loop(spark):
    """Surfaces that begin alike, hold others, have signs at their ends or characters beyond ASCII, in texts where they stand inside of words too."""
    rng = random.Random(5)
    pieces = ["a", "ab", "abc", "abcde", "abcdef", " ", " ", "-", "+", ".", "é", "通", "通义", "1", "_", "  "]
    words = [(f"e{n}", "".join(rng.choices(pieces, k=rng.randint(1, 4))), "t") for n in range(150)]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(400)]
    got = entities.match_entities(spark.createDataFrame([*enumerate(texts)], "n int, t string"), "t", [w for w in words if entities.fold(w[1])]).collect()
    assert {r.n: r.entity_hits for r in got} == {n: _plain_hits(t, [w for w in words if entities.fold(w[1])]) for n, t in enumerate(texts)}


def test_only_matched_surfaces_rule_out_names(spark):
    rows = [("We met Array Tools at Acme Labs, Acme Labs and 「新 產品」.",), ("Ray Tools and Array Tools",), (None,), ("New",)]
    got = editing.harvest(spark.createDataFrame(rows, "t string"), "t", [("r", "ray", "tool"), ("a", "acme", "company")]).collect()
    assert {r.t: r.candidates for r in got} == {rows[0][0]: ["Array Tools", "新 產品"], rows[1][0]: [], None: [], "New": []}
    assert got[0].__fields__ == ["t", "candidates"]


def test_dates_in_texts(spark):
    want = {
        "July 24, 2026": "2026-07-24", "on Sept. 9th , 2024 or so": "2024-09-09", "(June 2026)": "2026-06", "May 1-2, 2026": None, "Feb 30, 2026": None, "julyish 4, 2026": None,
        "Mar 3 2025; June 2026": "2025-03-03", "in 2026": None, "": None,
    }
    assert values(spark, list(want), lambda t: dates.entry_date(t)["iso"]) == list(want.values())
    assert values(spark, ["July 23", "July 23, 2025"], lambda t: dates.entry_date(t, F.lit("2026"))["iso"]) == ["2026-07-23", "2025-07-23"]
    only = ["July 24, 2026", " june 2026 ", "July 9th", "July 24, 2026 on", "", None, "24"]
    assert values(spark, only, dates.is_date_only) == [True, True, True, False, False, False, False]
    gap = values(spark, ["July 24, 2026 and july 9th, 2024, then May 1, 2025"], lambda t: dates.anchor_gap(F.array(F.lit("july-24-2026"), F.lit("july-9th-2024"), F.lit("top")), t))
    assert tuple(gap[0]) == (2, 3, 1)


def test_references(spark):
    text_ = "(docs/a.md) see a/b.py, a/b.pyx; ../up/c.md /abs/d.md 9x/e.md a/9x/f.md a/g.md/h x/.md lib/i.json.txt k.md a/b.py é/z.md"
    want = ["docs/a.md", "a/b.py", "a/g.md", "lib/i.json.txt"]
    assert values(spark, [text_, None, ""], rollups.references) == [want, [], []]


def test_names_without_titles(spark):
    want = {
        "Jane Doe, Ph. D., M.B.A.": "Jane Doe", "Bob Lee M D": "Bob Lee", "By Ann  Lee, D. Phil": "Ann  Lee", "MD": "MD", "Ann Lee III (guest)": "Ann Lee", "Ann Mad": "Ann Mad", "Lee, Jr., PhD": "Lee", None: "", " ; Ann Lee , ": "Ann Lee",
    }
    assert values(spark, list(want), text.author_name) == list(want.values())


def test_versions_near_names(spark):
    want = {
        "Claude Opus 4": True, "claude. 4": False, "xclaude 4": False, "claude" + " " * 40 + "4": True, "claude" + " " * 41 + "4": False, "a claude or a Claude; no 5": False, "claude; then gpt-5": True,
        "gptgpt5": True, "agptgpt5": False, "no names 5": False, None: False, "claude claude claude ٤": True,
    }
    assert values(spark, list(want), lambda t: text.mentions_version(t, ("claude", "gpt"))) == list(want.values())


def test_dead_references(spark):
    files = [
        ("README.md", "see scripts/run.py, scripts/gone.py, other/gone.md and scripts/x.py"), ("scripts/run.py", "lib/aa.py lib/bb.py _probe/x1.json"), ("scripts/lib/aa.py", ""),
        ("docs/design/new.md", "status: draft\n scripts/todo.py"), ("docs/design/old.md", "status: done\nscripts/todo.py scripts/todo.py"), ("empty.md", None),
    ]
    got = rollups.dead_references(spark.createDataFrame(files, "path string, text string")).collect()
    assert sorted(map(tuple, got)) == [("README.md", "scripts/gone.py"), ("docs/design/old.md", "scripts/todo.py"), ("scripts/run.py", "lib/bb.py")]


def test_queues_without_rows(spark):
    none = spark.createDataFrame([], "status string, ingested date, blockers array<string>, placeholder boolean")
    assert set(rollups.review_queue(none, F.lit(dt.date(2026, 1, 1)), ()).first()) == {0}
    empty = spark.createDataFrame([], "id long, field string, to string, seq long")
    assert [tuple(r) for r in rollups.answer_tally(empty).collect()] == [(None, 0, 0, 0)]
    assert spark.createDataFrame([], "v string").agg(rollups.exit_code("v", {"ok": 0})).first()[0] == 0
    assert [r.x for r in spark.createDataFrame([("a",)], "v string").agg(rollups.exit_code("v", {"ok": 0}).alias("x")).collect()] == [4]
    cells = spark.createDataFrame([(["b"], None), (["b"], []), (["b", "a"], ["a", "c"])], "want array<string>, got array<string>")
    assert [r.x and tuple(r.x) for r in cells.select(rollups.cell_differences(F.col("want"), F.col("got")).alias("x")).collect()] == [None, (["b"], []), (["b"], ["c"])]
    guard = spark.createDataFrame([(False, False, False), (True, True, False), (True, True, True)], "a boolean, b boolean, c boolean")
    assert [r.x for r in guard.select(rollups.may_write(F.col("a"), F.col("b"), F.col("c")).alias("x")).collect()] == [None, "already there", None]


def test_a_snapshot_is_taken_anew_only_when_it_is_old(spark):
    at, now = dt.datetime(2026, 7, 1), spark.createDataFrame([("a", 2.0), ("b", 3.0)], "key string, value double")
    for hours, want in ((11, [("a", 1.0)]), (12, [("a", 2.0), ("b", 3.0)])):
        state = spark.createDataFrame([("a", 1.0, at - dt.timedelta(hours=hours))], "key string, value double, ts timestamp")
        assert sorted((r.key, r.value) for r in rollups.advanced(state, now, F.lit(at), 12).collect()) == want
    none = spark.createDataFrame([], "key string, value double, ts timestamp")
    assert rollups.advanced(none, now, F.lit(at), 12).count() == 2


def test_what_fields_feeds_have(spark):
    rss = '<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>t</title><item><title>a</title><guid>g</guid><dc:creator>w</dc:creator></item><item><title> </title><link>u</link><guid>h</guid></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>a</title><link href="u"/><id>g</id><updated>d</updated><author><name>w</name></author></entry></feed>'
    rows = [("r", rss), ("a", atom), ("none", "<feed/>"), ("x", "<html/>"), ("bad", "<rss>"), ("null", None)]
    got = {r.source_id: (r.dialect, r.error, r["items"], r.title, r.link, r.date, r.guid, r.author, r.link_fallback_needed) for r in pages.inspect_feeds(spark.createDataFrame(rows, "source_id string, body string")).collect()}
    assert got == {
        "r": ("rss", None, 2, 1, 1, 0, 2, 1, True), "a": ("atom", None, 1, 1, 0, 1, 1, 1, True), "none": ("atom", None, 0, 0, 0, 0, 0, 0, False),
        "x": (None, "root html", None, None, None, None, None, None, None), "bad": (None, "unreadable", None, None, None, None, None, None, None), "null": (None, "unreadable", None, None, None, None, None, None, None),
    }
