"""Quality, events, gates, ledgers, digests and entities on boundaries and against plain loops."""

import datetime as dt
import itertools
import random
import time

from pyspark.sql import functions as F

from tidemark.operators import digests, entities, events, graph, ledgers, quality, similarity
from tidemark.plans import catalog
from tidemark.streaming import attach, state

AT = dt.datetime(2026, 7, 1)


def hours(n):
    return AT + dt.timedelta(hours=n)


def test_quality_of_a_rich_and_a_thin_signal(spark):
    schema = "title string, summary string, url string, author string, published timestamp, first_observed_at timestamp, category string, n_tags int, role string, tier int"
    rich = ("A title of a decent length for a paper", "s" * 900, "https://example.org/x", "A B", AT, hours(2), None, 3, "research", 1)
    thin = ("Hm", None, None, None, None, AT, None, 0, "aggregator", None)
    a, b = quality.score(spark.createDataFrame([rich, thin], schema)).orderBy(F.desc("total")).collect()
    assert (a.authority, a.richness, a.freshness, a.originality, a.completeness) == (24, 22, 18, 15, 14) and a.grade == "A" and a.lead_days == 0
    assert b.total < 40 and b.grade == "F" and b.lead_days is None
    assert b.flags == ["thin-content", "aggregator-only", "missing-date", "missing-category", "short-title", "no-tags"]


def test_roles_and_recency(spark):
    rows = [("aggregator", None, None), ("media", "research", None), ("kol", None, "social"), ("kol", None, None), ("official", "research", None), (None, None, None)]
    got = spark.createDataFrame(rows, "t string, c string, r string").select(quality.effective_role(F.col("t"), F.col("c"), F.col("r")).alias("x")).collect()
    assert [r.x for r in got] == ["aggregator", "media", "social", "expert", "research", "primary"]
    leads = spark.createDataFrame([(7,), (8,), (-1,), (None,)], "n int")
    assert [r.x for r in leads.select(quality.recent(F.col("n")).alias("x")).collect()] == [True, False, True, True]
    assert leads.filter(quality.recent(F.col("n"), 0)).count() == 4


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(n, n + 1) for n in range(1000, 1100)] + [(5000, n) for n in range(5001, 5200)] + [(9, None), (7777, 7777)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def belongs(a, b):
    """A plain form of the matching rule on rows of keyed()."""
    if a.at is None or b.at is None:
        return False
    apart = abs((a.at - b.at).total_seconds()) / 3600
    if a.fp and b.fp:
        return a.fp == b.fp and a.bucket == b.bucket and apart <= (168 if a.bucket == "incident" else 504)
    x, y = set(a.tokens), set(b.tokens)
    return apart <= 96 and bool(x) and bool(y) and len(x & y) / len(x | y) >= 0.30


TITLES = ("Alpha beta gamma launch", "Alpha beta gamma delta", "GPT-5 launch", "GPT-5 outage", "GPT-4o pricing", "alpha epsilon", "", "Claude Opus 4.5 released", "Outage of GPT-5 today", "beta gamma")


def signals(spark, n, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(TITLES), None if rng.random() < 0.05 else hours(rng.choice((0, 48, 96, 97, 168, 169, 504, 505, 300))), rng.choice((40, 70, 70, 90, 100)), rng.randrange(5)) for i in range(n)]
    return spark.createDataFrame(rows, "signal long, title string, at timestamp, eventability int, order int")


def test_matches_against_all_pairs(spark):
    k = events.keyed(signals(spark, 90, 4))
    rows = k.collect()
    got = {(r.signal, r.event) for r in events.match(k, k.withColumnRenamed("signal", "event")).collect()}
    assert got == {(a.signal, b.signal) for a in rows for b in rows if belongs(a, b)}


def test_leader_clustering_against_a_plain_loop(spark):
    for seed in (1, 2):
        s = signals(spark, 60, seed)
        rows = sorted(events.keyed(s).collect(), key=lambda r: (-r.eventability, r.order, r.signal))
        leaders, want = [], {}
        for r in rows:
            ranks = []
            for e in leaders:
                if belongs(r, e):
                    x, y = set(r.tokens), set(e.tokens)
                    ranks.append(((bool(r.fp and r.fp == e.fp), r.bucket == e.bucket, round(len(x & y) / len(x | y), 6) if x and y else 0.0), e.signal))
            top = max((x for x, _ in ranks), default=None)
            best = [e for x, e in ranks if x == top]
            if len(best) == 1:
                want[r.signal] = (best[0], "attached")
            elif r.eventability >= 70:
                leaders.append(r)
                want[r.signal] = (r.signal, "opened")
            else:
                want[r.signal] = (None, "deferred")
        assert {r.signal: (r.event, r.state) for r in events.lead_events(s).collect()} == want


def test_leaders_among_many_copies(spark, monkeypatch):
    """As one after the other, in parts of any size; copies are compared as classes."""
    rng = random.Random(5)
    texts = ["GPT-5 launch notes", "GPT-5 launch notes again", "GPT-5 outage report", "Plain maintenance note k1", "plain maintenance note k2", "the of", None]
    rows = [(k, rng.choice(texts), rng.choice([None, *map(hours, range(0, 900, 150))]), rng.choice([90, 80, 70, 60]), k) for k in range(400)]
    s = spark.createDataFrame(rows, "signal long, title string, at timestamp, eventability int, order long")
    leaders, want = [], set()
    for r in sorted(events.keyed(s).collect(), key=lambda r: (-r.eventability, r.order)):
        x, ranks = set(r.tokens or ()), []
        for e in leaders:
            if belongs(r, e):
                y = set(e.tokens or ())
                ranks.append(((bool(r.fp and r.fp == e.fp), r.bucket == e.bucket, round(len(x & y) / len(x | y), 6) if x and y else 0.0), e.signal))
        best = [e for k, e in ranks if k == max(ranks)[0]]
        if len(best) != 1 and r.eventability >= 70:
            leaders.append(r)
        want.add((r.signal, *((best[0], "attached") if len(best) == 1 else (r.signal, "opened") if r.eventability >= 70 else (None, "deferred"))))
    made, match = [], events.match
    monkeypatch.setattr(events, "match", lambda *x: made.append(match(*x)) or made[-1])
    for first in (30, 2_000):
        monkeypatch.setattr(events, "FIRST_PART", first, raising=False)
        made.clear()
        assert {tuple(r) for r in events.lead_events(s).collect()} == want
        assert sum(m.count() for m in made) < 5_000


def test_attach_best_is_attach_with_copies(spark):
    rng = random.Random(8)
    texts = ["GPT-5 launch notes", "gpt-5 launch notes again", "GPT-5 outage report", "Plain maintenance note k1", "plain maintenance note k2", "Claude Opus 4.1 launch notes", "the of", None]
    rows = [(k, rng.choice(texts), rng.choice([None, *map(hours, range(0, 700, 45))])) for k in range(160)]
    signals = spark.createDataFrame(rows[:100], "signal long, title string, at timestamp")
    known = spark.createDataFrame([(e, t, at) for e, t, at in rows[100:]], "event long, title string, at timestamp")
    want = sorted(events.attach(events.match(events.keyed(signals), events.keyed(known))).collect())
    assert want and sorted(events.attach_best(signals, known).collect()) == want
    # a class of copies is compared once
    copies = spark.range(3000).selectExpr("id as signal", "'Plain note' as title", "timestamp_seconds(id % 3) as at")
    classes, members = events.classes_of(copies, "signal")
    assert sorted((r.signal, r.n) for r in classes.collect()) == [(0, 1000), (1, 1000), (2, 1000)] and members.count() == 3000
    assert events.attach_best(copies, copies.limit(1).withColumnRenamed("signal", "event")).count() == 3000


def test_reposts(spark):
    base = ["one", "two", "three"]
    rows = [
        (1, "e", "en", hours(5), None, base, ["x"], 1, 0), (2, "e", "en", hours(0), None, base, ["x"], 2, 1), (3, "e", "zh", hours(53), None, ["four"], ["x"], 1, 2),
        (4, "e", "en", hours(400), None, base, ["x"], 1, 3), (5, "f", "en", hours(0), None, base, ["x"], 1, 0), (6, "e", None, None, None, base, ["x"], 1, 4),
    ]
    ev = spark.createDataFrame(rows, "node long, event string, lang string, at timestamp, fp string, tokens array<string>, entities array<string>, tier int, pos int")
    marked = {rule: {r.node for r in events.reposts(ev, rule).filter("suspected_repost").collect()} for rule in ("verbatim", "translated")}
    assert marked == {"verbatim": {1}, "translated": {3}}


def test_reposts_of_copies(spark):
    """Against all pairs; copies make no links among each other, so these grow with the copies, not with their square."""
    rng = random.Random(5)
    texts = [["one", "two"], ["one", "three"], ["four"], [f"w{n}" for n in range(20)], [f"w{n}" for n in range(21)], []]
    sets = [["x"], ["y", "z"], ["y", None], []]
    columns = "node long, event string, lang string, at timestamp, fp string, tokens array<string>, entities array<string>, tier int, pos int"
    for n, span in ((150, 900), (150, 60)):
        rows = [
            (k, rng.choice(["e", "e", "f", None]), rng.choice(["en", "zh", " ", None]), rng.choice([None, *map(hours, range(0, span, 9))]), rng.choice([None, None, "p", "q"]), rng.choice(texts), rng.choice(sets), rng.choice([None, 1, 2]), k)
            for k in range(n)
        ]
        for rule, place, least, within in (("verbatim", 5, 0.95, 168), ("translated", 6, 0.8, 48)):
            root = list(range(n))

            def find(k):
                return k if root[k] == k else find(root[k])

            for a, b in itertools.combinations(rows, 2):
                one, two = (set(r[place]) - {None} for r in (a, b))
                alike = a[1] and a[1] == b[1] and a[3] and b[3] and abs(a[3] - b[3]) <= dt.timedelta(hours=within) and one and two and len(one & two) / len(one | two) >= least
                if alike and (rule == "verbatim" or ((a[2] or "").strip() and (b[2] or "").strip() and a[2] != b[2] and (not a[4] or not b[4] or a[4] == b[4]))):
                    root[find(a[0])] = find(b[0])
            groups = {}
            for r in rows:
                groups.setdefault(find(r[0]), []).append(r)
            turn = lambda r: (r[3], 99 if r[7] is None else r[7], r[8])
            want = {r[0] for g in groups.values() if len(g) > 1 for r in sorted(g, key=turn)[1:]}
            assert want and {r.node for r in events.reposts(spark.createDataFrame(rows, columns), rule).filter("suspected_repost").collect()} == want
    copies = spark.createDataFrame([(k, "e", ["en", "zh"][k % 2], hours(k % 40), None, texts[0], sets[0], 1, k) for k in range(2000)], columns)
    for rule in ("verbatim", "translated"):
        points, links = events.repost_links(copies, rule)
        assert points.count() == 40 and links.count() <= 4 * 40
        assert events.reposts(copies, rule).filter("suspected_repost").count() == 1999


def test_voices(spark):
    rows = [(1, "e", "s1", "g", None), (2, "e", "s2", "g", "p"), (3, "e", "s3", None, "p"), (4, "e", "s4", None, None), (5, "e", None, " ", None), (6, "f", "s1", "g", None)]
    got = events.independent_voices(spark.createDataFrame(rows, "node long, event string, source_id string, media_group string, person_id string"))
    assert {r.event: r.voices for r in got.collect()} == {"e": 3, "f": 1}


def test_voices_search_only_ties_that_may_close_a_circle(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, rng.choice(["e", "f", "g", None]), rng.choice(["s", None]), rng.choice([None, " ", *"abcdef"]), rng.choice([None, "", *"uvwxyz"])) for k in range(60)]
    rows += [(100 + k, "tree", None, "a", f"p{k}") for k in range(50)]
    want = {}
    for event in {r[1] for r in rows}:
        sets = []
        for node, of, source, group, person in rows:
            if of == event:
                own = {("g", group)} if (group or "").strip() else set()
                own |= {("p", person)} if person else set()
                own = own or {("s", source or node)}
                met = [x for x in sets if x & own]
                sets = [x for x in sets if not x & own] + [own.union(*met)]
        want[event] = len(sets)
    searched, components = [], events.connected_components
    monkeypatch.setattr(events, "connected_components", lambda edges: searched.append(edges.count()) or components(edges))
    got = events.independent_voices(spark.createDataFrame(rows, "node long, event string, source_id string, media_group string, person_id string"))
    assert {r.event: r.voices for r in got.collect()} == want and want["tree"] == 1
    assert searched[0] < 60


def test_coverage_and_availability(spark):
    ev = spark.createDataFrame([("a", AT), ("a", hours(3)), ("b", AT), ("b", None)], "event string, first_fetch timestamp")
    assert {r.event: r.observable_from for r in events.observable_from(ev).collect()} == {"a": AT, "b": None}
    rows = spark.createDataFrame([(AT, AT), (hours(-1), AT), (AT, None), (None, AT)], "h timestamp, o timestamp")
    assert [r.x for r in rows.select(events.coverage_state(F.col("h"), F.col("o")).alias("x")).collect()] == ["observed", "backfilled", "unknown", "unknown"]
    cases = [(True, "text", "ai-input=no", None), (False, "", None, None), (True, " ", "ai-input=no", True), (True, None, "excerpt ok", None), (True, None, None, True), (True, None, "title only", False)]
    got = spark.createDataFrame(cases, "s boolean, t string, n string, e boolean").select(events.availability(F.col("s"), F.col("t"), F.col("n"), F.col("e")).alias("x"))
    assert [r.x for r in got.collect()] == ["has_text", "unfetched", "withheld", "unfetched", "unfetched", "withheld"]


CLEAN = {"placeholder": False, "fact_chars": 20, "summary_chars": 20, "thin": "has_text", "category": "vendor", "impact_chars": 0, "context_chars": 0, "company": "Acme", "n_keywords": 1, "track": "t",
         "n_evidence": 1, "primary_evidence": 1, "confidence": 60, "heat": None, "signals": 0, "voices": 1, "platforms": None}
GATE = ("placeholder boolean, fact_chars int, summary_chars int, thin string, category string, impact_chars int, context_chars int, company string, n_keywords int, track string, n_evidence int,"
        " primary_evidence int, confidence int, heat int, signals int, voices int, platforms int")  # fmt: skip


def test_each_blocker(spark):
    cases = [
        ({}, []), ({"placeholder": True}, ["placeholder_content"]), ({"fact_chars": 19}, ["thin_fact"]), ({"summary_chars": 0, "thin": "unfetched"}, ["thin_unfetched"]),
        ({"fact_chars": 0, "thin": "withheld"}, ["thin_by_policy"]), ({"category": "Research", "impact_chars": 39, "context_chars": 30}, ["thin_research_analysis"]),
        ({"category": "paper", "impact_chars": 40, "context_chars": 30}, []), ({"company": " Unknown "}, ["generic_entity"]), ({"category": None}, ["missing_category"]),
        ({"n_keywords": 0, "track": None, "n_evidence": None}, ["missing_keywords", "missing_track", "missing_evidence"]), ({"primary_evidence": None}, ["missing_primary_evidence"]),
        ({"confidence": 59}, ["low_confidence"]), ({"heat": 0}, ["unmeasured_heat"]), ({"heat": 70, "signals": 1, "voices": 2, "platforms": 1}, ["unsupported_heat"]),
        ({"heat": 69, "signals": 1}, []),
    ]
    df = spark.createDataFrame([tuple((CLEAN | x).values()) for x, _ in cases], GATE)
    assert [r.b for r in df.select(events.blockers().alias("b")).collect()] == [want for _, want in cases]


def test_transitions(spark):
    rows = [("review", [], 7), ("review", [], 8), ("published", ["x"], None), ("published", [], 8), ("dropped", [], 0), ("review", ["x"], 0)]
    got = spark.createDataFrame(rows, "s string, c array<string>, l int").select(events.next_status(F.col("s"), F.col("c"), F.col("l")).alias("x"))
    assert [r.x for r in got.collect()] == ["published", "review", "published", "review", "dropped", "review"]


def test_health_against_a_plain_fold(spark):
    rng = random.Random(5)
    status = ["200", "304", "503", "404", "error", "403", "429", "teapot", None]
    rows = [(s, n, rng.choice(status)) for s in range(6) for n in range(40)]
    df = spark.createDataFrame(rows, "source int, seq int, status string").withColumn("outcome", ledgers.outcome(F.col("status")))
    points = {"200": 8, "304": 3, "503": -15, "error": -15, "404": -25}
    for r in ledgers.health(df).collect():
        score, bad, good, quiet = 100, 0, 0, 0
        for _, _, st in [x for x in rows if x[0] == r.source]:
            score = max(0, min(100, score + points.get(st, 0)))
            if st in ("200", "304"):
                bad, good = 0, good + 1
            elif st in points:
                bad, good = bad + 1, 0
            else:
                quiet += 1
        assert (r.score, r.consecutive_failures, r.consecutive_successes, r.neutral_runs, r.runs) == (score, bad, good, quiet, 40)
    assert {r.source: r.streak for r in ledgers.last_streak(df, ("failure", "severe_failure")).collect()} == {r.source: r.consecutive_failures for r in ledgers.health(df).collect()}


def test_health_decisions(spark):
    rows = [("dormant", 9, 0, None, None, "skip"), ("degraded", 5, 0, None, None, "quarantine_candidate"), ("degraded", 0, 3, "health", "active", "restore:active"),
            ("degraded", 0, 3, "health", "odd", "restore:probing"), ("degraded", 0, 3, None, "active", "keep"), ("active", 2, 0, None, None, "degrade"), ("probing", 1, 0, None, None, "keep")]
    df = spark.createDataFrame(rows, "l string, f int, s int, d string, p string, want string")
    assert all(r.x == r.want for r in df.select("want", ledgers.health_decision(*[F.col(c) for c in "lfsdp"]).alias("x")).collect())


def test_rows_of_a_similarity_join_carry_numbers(spark):
    """A row of the join repeats its set for each token of its prefix: as words, long ones made it many times as large."""
    words = [f"{'w' * 200}{k}" for k in range(6)]
    rows = spark.createDataFrame([(1, words[:5], "a"), (2, words[:4], "a"), (3, words[4:], "a"), (4, words[:5], "b"), (5, [], "a"), (6, [None, words[0]], "b")], "id long, tokens array<string>, s string")
    met = similarity.candidates(rows, rows, 0.3, ("s",), once=True)
    assert dict(met.dtypes)["left_order"] == dict(met.dtypes)["right_order"] == "array<bigint>"
    got = {(r.left, r.right, round(r.similarity, 6)) for r in similarity.similar_pairs(rows, rows, 0.1, ("s",), once=True).collect()}
    assert got == {(1, 2, 0.8), (1, 3, 0.166667), (4, 6, 0.2)}


def test_boards(spark):
    now = spark.createDataFrame([("a", 1300, AT), ("b", 260, AT), ("c", 900, AT), ("d", 5, AT)], "name string, stars long, at timestamp")
    before = spark.createDataFrame([("a", 1000, hours(-24)), ("b", 200, hours(-24)), ("d", 4, hours(-6))], "name string, prev_stars long, prev_at timestamp")
    rows = ledgers.velocities(now, before)
    assert [(r.name, r.velocity) for r in ledgers.board(rows, "velocity").orderBy("rank").collect()] == [("a", 300.0), ("b", 60.0), ("d", 2.0), ("c", None)]
    surge = ledgers.board(rows, "surge")
    assert [(r.name, r.surge) for r in surge.orderBy("rank").collect()] == [("a", 30.0), ("b", 30.0)]
    assert [r.name for r in ledgers.interleave([ledgers.board(rows, "velocity"), surge]).orderBy("pos", "board").collect()] == ["a", "b", "d", "c"]
    moves = [(None, None, None, 1, "first_seen"), (True, False, None, 1, "no_baseline"), (True, True, None, 1, "entered"), (True, True, 3, 1, "up"), (True, True, 1, 3, "down"), (True, True, 2, 2, "flat")]
    df = spark.createDataFrame(moves, "k boolean, h boolean, p int, n int, want string")
    assert all(r.x == r.want for r in df.select("want", ledgers.rank_move(*[F.col(c) for c in "khpn"]).alias("x")).collect())


def test_gap_lights(spark):
    rows = [(0, 0, True, "white"), (1, 0, True, "red"), (0, 5, True, "white"), (3, 1, True, "amber"), (4, 1, True, "red"), (1, 1, True, "green"), (9, 1, False, "unmeasurable")]
    df = spark.createDataFrame(rows, "d long, i long, m boolean, want string")
    assert all(r.x == r.want for r in df.select("want", ledgers.gap_light(F.col("d"), F.col("i"), F.col("m")).alias("x")).collect())


def test_ledger_rules(spark):
    rows = spark.createDataFrame([(1, "f", 0, None, "a"), (1, "f", 1, "a", "b"), (1, "f", 2, "x", "c"), (2, "f", 0, None, None)], "id int, field string, seq int, from string, to string")
    assert {(r.id, r.to) for r in ledgers.latest(rows).collect()} == {(1, "c"), (2, None)}
    assert [(r.id, r.seq) for r in ledgers.breaks(rows).collect()] == [(1, 2)]


def test_draft_rules(spark):
    items = spark.createDataFrame([("d", "e1", ["u1"], True), ("d", "e2", ["u2"], False)], "date string, id string, urls array<string>, withheld boolean")
    sections = spark.createDataFrame(
        [("d", "s1", "A", "fine", ["e1"], None, None, None), ("d", "s2", "B", "x", [], " ", None, None), ("d", "s3", "C", "x", [], None, "short", None), ("d", "s4", "D", "x", ["e9"], None, None, "u1"),
         ("d", "s4", "E", "x", [], None, None, None)], "date string, id string, layer string, text string, evidence array<string>, basis string, counter string, source_url string")
    got = sorted((r.code, r.detail) for r in digests.draft_rejects(sections, items).collect())
    assert got == [("b_without_basis", "s2"), ("bad_layer", "s4"), ("counter_too_thin", "s3"), ("duplicate_id", "s4"), ("unaccounted_material", "e2"), ("unknown_event", "s4")]


def test_entities(spark):
    words = [("acme", "Acme", "company"), ("acme-labs", "Acme Labs", "company"), ("ai", "AI", "technology"), ("zhipu", "智谱", "company")]
    texts = ["Acme Labs ships AI", "brain and acme", "智谱AI", "rail AI", None, "ＡＣＭＥ"]
    got = entities.match_entities(spark.createDataFrame([*enumerate(texts)], "n int, t string"), "t", words).orderBy("n").collect()
    assert [r.entity_hits for r in got] == [["acme-labs", "ai"], ["acme"], ["zhipu"], [], [], ["acme"]]
    assert got[0].entity_types == ["company", "technology"]


def plain_pairs(left, right, threshold, hours_, once):
    out = set()
    for i, x, at, s in left:
        for j, y, to, t in right:
            a, b = set(x or ()), set(y or ())
            if not a or not b or s is None or s != t or (once and i >= j):
                continue
            if hours_ is not None and (at is None or to is None or abs((at - to).total_seconds()) > hours_ * 3600):
                continue
            if len(a & b) / len(a | b) >= threshold:
                out.add((i, j, round(len(a & b) / len(a | b), 9)))
    return out


def test_similarity_joins_against_loops(spark):
    schema = "id long, tokens array<string>, at timestamp, s string"
    for seed, threshold, hours_, once in ((1, 0.3, 96, False), (2, 0.5, None, True), (3, 0.95, 168, True), (4, 1.0, 1, False), (5, 0.8, 48, True)):
        rng = random.Random(seed)

        def rows(n, base):
            words = lambda: [rng.choice("abcdefghij") for _ in range(rng.randrange(0, 7))] + ["all"] * rng.randrange(2)
            return [(base + k, words() if rng.random() < 0.95 else None, hours(rng.choice((0, 1, 47, 48, 96, 97, 168, 169, -3))) if rng.random() < 0.95 else None, rng.choice(("x", "y", None))) for k in range(n)]

        left = rows(60, 0)
        right = left if once else rows(60, 1000)
        a, b = (spark.createDataFrame(x, schema) for x in (left, right))
        got = [(r.left, r.right, round(r.similarity, 9)) for r in similarity.similar_pairs(a, b, threshold, ("s",), hours_, once).collect()]
        assert len(got) == len(set(got)) and set(got) == plain_pairs(left, right, threshold, hours_, once), seed
    none = spark.createDataFrame([], schema)
    assert similarity.similar_pairs(none, none, 0.5).count() == 0


def test_candidates_follow_results(spark):
    """A token that every title has makes no candidates, as rarer ones stand before it."""
    n = 3000
    rows = spark.range(n).selectExpr("id", "array('every', 'title', concat('own', id), concat('also', id), concat('pair', id div 2), concat('both', id div 2), concat('two', id div 2)) AS tokens")
    found = similarity.candidates(rows, rows, 0.5, once=True)
    assert found.count() == n // 2 == similarity.similar_pairs(rows, rows, 0.5, once=True).count()


def test_many_copies_of_a_title_are_settled_in_a_few_rounds(spark):
    """Every node matches every earlier one with the same rank; a chain whose links wait for each other as well."""
    n = 60
    clique = [(b, a, 7.0) for a in range(n) for b in range(a + 1, n)]
    nodes = spark.range(n).withColumnRenamed("id", "signal")
    assert [r.signal for r in events.settle_leaders(nodes, spark.createDataFrame(clique, "signal long, event long, rank double"), 3).collect()] == [0]
    chain = spark.createDataFrame([(k, k - 1, 1.0) for k in range(1, 9)], "signal long, event long, rank double")
    assert sorted(r.signal for r in events.settle_leaders(spark.range(9).withColumnRenamed("id", "signal"), chain).collect()) == [0, 2, 4, 6, 8]


def test_leaders_on_random_graphs(spark):
    for seed in range(4):
        rng = random.Random(seed)
        n = 40
        edges = [(b, a, float(rng.choice((1, 2, 3)))) for b in range(n) for a in range(b) if rng.random() < 0.15]
        leaders = set()
        for b in range(n):
            ranks = [r for x, a, r in edges if x == b and a in leaders]
            if ranks.count(max(ranks, default=0)) != 1:
                leaders.add(b)
        got = events.settle_leaders(spark.range(n).withColumnRenamed("id", "signal"), spark.createDataFrame(edges, "signal long, event long, rank double"))
        assert {r.signal for r in got.collect()} == leaders


def run_stream(spark, made, at):
    out = []
    query = made.writeStream.outputMode("append").foreachBatch(lambda b, n: out.extend(map(tuple, b.collect()))).option("checkpointLocation", at).trigger(availableNow=True).start()
    query.awaitTermination()
    return out


def slices(spark, rows, schema, parts, to):
    """rows as a stream that takes a part at a time, and a last row that lets all others be told."""
    import time

    for part in [*parts, [(None, None, dt.datetime(2100, 1, 1)) if "title" in schema else (None, dt.datetime(2100, 1, 1), None)]]:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(to)
        time.sleep(0.05)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(to)


def test_attaching_on_a_stream_is_the_same_for_any_split(spark, tmp_path):
    schema, rng = "id long, title string, at timestamp", random.Random(5)
    rows = sorted(((i, rng.choice(TITLES), hours(rng.choice((0, 48, 96, 97, 168, 169, 504, 505, 300, 1200)))) for i in range(50)), key=lambda r: r[2])
    known = [(1000 + i, rng.choice(TITLES), hours(rng.choice((0, 1, 60, 300)))) for i in range(8)]
    known.sort(key=lambda r: r[2])
    keyed = [events.keyed(spark.createDataFrame(x, schema)).withColumnRenamed("id", k) for x, k in ((rows, "signal"), (known, "event"))]
    want = {(r.signal, r.event) for r in events.attach(events.match(*keyed)).collect()}
    assert want
    for n, (cut, late) in enumerate((([0], "1 day"), ([20, 20, 37], "0 seconds"), ([7, 30], "60 days"))):
        parts = [rows[a:b] for a, b in zip([0, *cut], [*cut, len(rows)], strict=True)]
        early = [known[:4], known[4:]] if n else [known]
        signals_, events_ = (slices(spark, x, schema, p, str(tmp_path / f"{k}{n}")) for x, p, k in ((rows, parts, "s"), (known, early, "e")))
        told = run_stream(spark, attach.attach_stream(signals_, events_, late=late), str(tmp_path / f"log{n}"))
        assert {(s, e) for s, _, e, _ in told if e is not None} == want, n
        assert sorted(s for s, *_ in told if s is not None) == [r[0] for r in sorted(rows)]


def test_copies_are_one_class_of_a_stream(spark, tmp_path):
    """The state and the join have a row a class and key, whatever the number of copies; each copy is told."""
    schema = "id long, title string, at timestamp"
    rows, known = [(i, "Plain note", hours(i % 3)) for i in range(600)], [(1000, "Plain note", hours(0)), (1001, "Plain other thing", hours(0))]
    made = attach.attach_stream(*(slices(spark, x, schema, [x], str(tmp_path / k)) for k, x in (("s", rows), ("e", known))))
    query = made.writeStream.outputMode("append").format("memory").queryName("copies").option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    query.awaitTermination()
    put = sum(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"] if o["operatorName"] == "symmetricHashJoin")
    assert 0 < put <= 30
    told = spark.table("copies").filter("event = 1000")
    assert told.count() == told.select("signal").distinct().count() == 600


def test_editions_count_an_event_once(spark, tmp_path):
    schema = "id long, at timestamp, open boolean"
    first = [(1, hours(1), True), (2, hours(2), False), (1, hours(1), True), (3, None, True)]
    second = [(2, hours(2), False), (4, hours(25), True)]
    told = run_stream(spark, attach.edition_days(slices(spark, None, schema, [first, second], str(tmp_path / "p"))), str(tmp_path / "log"))
    assert sorted(told) == [(AT.date(), 2, 1), (hours(24).date(), 1, 1)]


def test_a_batch_tells_its_own_keys_and_a_restart_goes_on(spark, tmp_path):
    schema, to = "k string, at timestamp", str(tmp_path / "in")
    told = []

    def go():
        seen = state.first_seen(spark.readStream.schema(schema).parquet(to), ["k"], "at")
        seen.writeStream.outputMode("update").foreachBatch(lambda b, n: told.append([(*map(tuple, b.collect()), n)])).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()

    spark.createDataFrame([("a", hours(3)), ("b", hours(1)), ("a", hours(2))], schema).write.mode("append").parquet(to)
    go()
    spark.createDataFrame([("a", hours(1)), ("c", hours(9))], schema).write.mode("append").parquet(to)
    go()
    rows = [r for batch in told for r in batch[0][:-1]]
    assert sorted(rows) == [("a", hours(1), 3), ("a", hours(2), 2), ("b", hours(1), 1), ("c", hours(9), 1)]
    batches = spark.createDataFrame([(*r, n) for n, batch in enumerate(told) for r in batch[0][:-1]], "k string, first_observed_at timestamp, observations long, batch int")
    assert {tuple(r) for r in state.latest(batches, ["k"]).collect()} == {("a", hours(1), 3), ("b", hours(1), 1), ("c", hours(9), 1)}


def test_health_is_the_same_for_any_chunks(spark):
    """A source with most of the runs is split by time, and the steps of its parts compose to the plain fold."""
    rng, points = random.Random(4), dict(ledgers.POINTS)
    rows = [(0 if rng.random() < 0.7 else rng.randrange(1, 6), n, rng.choice(("success", "failure", "severe_failure", "not_modified", "neutral", None))) for n in range(600)]
    want = {}
    for source, _, what in rows:
        score, runs, neutral, bad, good = want.get(source, (100, 0, 0, 0, 0))
        score = max(0, min(100, score + points.get(what, 0)))
        if what in ("success", "not_modified"):
            bad, good = 0, good + 1
        elif what in ("failure", "severe_failure"):
            bad, good = bad + 1, 0
        else:
            neutral += 1
        want[source] = (score, runs + 1, neutral, bad, good)
    df = spark.createDataFrame(rows, "source long, seq long, outcome string")
    for chunk in (20_000, 100, 7):
        assert {r[0]: tuple(r)[1:] for r in ledgers.health(df, chunk).collect()} == want, chunk
    assert ledgers.health(df.limit(0)).count() == 0
    state_ = None
    for low, high in ((0, 100), (100, 101), (101, 600)):
        state_ = state.courses(df.filter(f"seq >= {low} and seq < {high}"), state_)
    assert {r[0]: tuple(r)[1:] for r in ledgers.health_of(state_).collect()} == want


def test_a_large_dictionary(spark):
    """Fifty thousand surfaces from a table: in no expression, and a text meets those alone that begin like a part of it."""
    dictionary = spark.range(50_000).selectExpr("concat('e', id) AS id", "concat('Name', id, ' Works') AS surface", "'company' AS type", "id AS rank")
    texts = spark.range(200).selectExpr("id AS n", "concat('At name', id * 7, ' works and xname', id, ' works') AS t")
    got = {r.n: r.entity_hits for r in entities.match_entities(texts, "t", dictionary).collect()}
    assert got == {n: [f"e{n * 7}"] for n in range(200)}
    met = entities.candidates(texts.select(entities.folded(F.col("t")).alias("folded")), entities.terms_of(dictionary))
    assert met.count() == 399


def test_keys_of_a_text_do_not_carry_it(spark):
    """A text has a row a key in the join with the dictionary, which must not have the text in it, and keys at word starts alone."""
    texts = spark.createDataFrame([("abcde " * 3 + "fabcde zé abcde",), ("xabcde then abcde",), ("éabcde",)], "folded string")
    terms = entities.terms_of(spark.createDataFrame([("e", "abcde", "t", 0), ("f", "zé", "t", 1)], "id string, surface string, type string, rank long"))
    found = entities.candidates(texts, terms, free=True)
    assert sorted((r.folded[:3], r.term, r.at) for r in found.collect()) == [("abc", "abcde", 1), ("abc", "zé", 26), ("xab", "abcde", 2)]
    got = entities.match_entities(texts, "folded", terms.selectExpr("entity as id", "term as surface", "type", "rank")).select("folded", "entity_hits").collect()
    assert {r.folded[:3]: r.entity_hits for r in got} == {"abc": ["e", "f"], "xab": [], "éab": []}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    generated = [line for line in plan.splitlines() if "Generate explode" in line]
    assert generated and not any("folded" in line.split("], ")[-1] for line in generated)


def _shuffled_rows(spark):
    context = spark.sparkContext
    context._jsc.sc().listenerBus().waitUntilEmpty()
    stages = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)
    return sum(stages.apply(n).shuffleWriteRecords() for n in range(stages.size()))


def test_a_text_meets_no_term_that_only_begins_like_a_part_of_it(spark):
    """Of three thousand surfaces that begin alike each text has two; what is shuffled grows with those, and not with a row a text and surface."""
    dictionary = spark.range(3000).selectExpr("concat('e', id) AS id", "concat('the term', id) AS surface", "'t' AS type", "id AS rank")
    texts = spark.range(200).selectExpr("id AS n", "concat('the term', id, ' and the term', id + 1000, ', not the term', id, 'x') AS t")
    before = _shuffled_rows(spark)
    got = {r.n: r.entity_hits for r in entities.match_entities(texts, "t", dictionary).collect()}
    assert got == {n: [f"e{n}", f"e{n + 1000}"] for n in range(200)}
    assert _shuffled_rows(spark) - before < 30_000


def test_a_title_of_many_words_against_its_dictionary(spark, tmp_path):
    """The words of a title are made once, not again for each of its pairs, and its hits are chosen without comparing all with all."""
    words = " ".join(f"w{'abcdefghij'[n % 10]}{'klmnopqrst'[n // 10 % 10]}" for n in range(30_000))
    rows = [(1, f"{words}\nrest", "en", "s1"), (2, "wak wbk, wakx", "en", "s2"), (3, None, "en", "s3"), (4, "\n", "en", "s4")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    began = time.perf_counter()
    got = {r.doc_id: r.entity_hits for r in catalog.queries()["q60_entity_match"](spark, str(tmp_path)).collect()}
    assert time.perf_counter() - began < 60
    assert (got[2], got[3], got[4]) == ("wak wbk", "", "")
    assert got[1] == ",".join(f"w{a}{c} w{b}{c}" for c in "klmnopqrst" for a, b in ("ab", "cd", "ef", "gh", "ij"))
