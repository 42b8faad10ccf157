"""Queries on registries, review queues, sources' yield, neighbours and courses of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import events, registries, rollups
from tidemark.plans.base import SIGNALS, query, signals, table
from tidemark.plans.scoring import _GATE_SQL, _ROLLED_SQL, _gate_rows, _rolled
from tidemark.sources import export, pages


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a registry of the documents' sources: a third isn't in it, some are dormant, one has no tier."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").filter("n_nationkey % 3 <> 2").select(
        F.concat(F.lit("src"), k).alias("id"), F.expr("element_at(array('official', 'media', 'kol', 'aggregator'), n_nationkey % 4 + 1)").alias("track"), F.when(k % 5 > 0, k % 3 + 1).cast("int").alias("tier"),
        F.expr("element_at(array('primary', 'aggregator', 'media'), n_nationkey % 3 + 1)").alias("role"), F.expr("element_at(array('vendor', 'research', 'aggregator', 'industry'), n_nationkey % 4 + 1)").alias("source_category"),
        F.when(k % 7 == 3, "dormant").when(k % 2 == 0, "active").alias("lifecycle"), F.col("n_name").alias("language"),
    )


_REGISTRY_SQL = """r AS (
  SELECT 'src' || n_nationkey AS id, ['official', 'media', 'kol', 'aggregator'][n_nationkey % 4 + 1] AS track, CASE WHEN n_nationkey % 5 > 0 THEN n_nationkey % 3 + 1 END AS tier,
    ['primary', 'aggregator', 'media'][n_nationkey % 3 + 1] AS role, ['vendor', 'research', 'aggregator', 'industry'][n_nationkey % 4 + 1] AS category,
    CASE WHEN n_nationkey % 7 = 3 THEN 'dormant' WHEN n_nationkey % 2 = 0 THEN 'active' END AS lifecycle FROM nation WHERE n_nationkey % 3 <> 2
)"""


def _sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = signals(spark, sf_dir).select("doc_id", F.col("source").alias("source_id"), "track", "tier")
    return registries.with_sources(s, _registry(spark, sf_dir))


@query(f"""WITH {SIGNALS}, {_REGISTRY_SQL} SELECT doc_id, CASE WHEN r.id IS NULL THEN s.track ELSE r.track END AS track, CASE WHEN r.id IS NULL THEN s.tier ELSE r.tier END AS tier, r.role, r.category AS source_category,
  CASE WHEN r.id IS NULL THEN 'missing' ELSE 'known' END AS state FROM signals s LEFT JOIN r ON s.source = r.id WHERE r.lifecycle IS DISTINCT FROM 'dormant'""")
def q63_signal_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sourced(spark, sf_dir).filter("state <> 'dormant'").select("doc_id", "track", "tier", "role", "source_category", "state")


@query(f"""WITH {SIGNALS}, {_REGISTRY_SQL} SELECT source AS source_id, CASE WHEN r.id IS NULL THEN 'missing' WHEN r.lifecycle = 'dormant' THEN 'dormant' ELSE 'known' END AS state, count(*) AS n
FROM signals s LEFT JOIN r ON s.source = r.id GROUP BY 1, 2""")
def q64_source_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sourced(spark, sf_dir).groupBy("source_id", "state").agg(F.count("*").alias("n"))


@query(f"""WITH {_REGISTRY_SQL}, t AS (SELECT l_orderkey AS event, coalesce(tier, 3) AS tier, coalesce(tier, 3) = 1 AND role IS DISTINCT FROM 'aggregator' AND category IS DISTINCT FROM 'aggregator' AS first
  FROM lineitem LEFT JOIN r ON r.id = 'src' || (l_suppkey % 25)) SELECT event, count(*) FILTER (first) AS primary_evidence, min(tier) AS best_tier, sum(tier)::BIGINT AS tiers FROM t GROUP BY event""")
def q65_evidence_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event"), F.concat(F.lit("src"), F.col("l_suppkey") % 25).alias("source_id"))
    told = registries.evidence_tiers(ev, _registry(spark, sf_dir))
    return told.groupBy("event").agg(F.count_if("primary").alias("primary_evidence"), F.min("tier").alias("best_tier"), F.sum("tier").alias("tiers"))


@query(f"""WITH {SIGNALS}, {_REGISTRY_SQL}, j AS (SELECT s.source, s.doc_id, coalesce(r.category, '') AS category, coalesce(r.track, '') AS track, coalesce(r.role, '') AS role, r.tier FROM signals s LEFT JOIN r ON s.source = r.id)
SELECT CASE WHEN category = 'aggregator' OR track = 'aggregator' THEN 'aggregator' WHEN category = 'research' OR role LIKE '%research%' THEN 'research' WHEN category IN ('vendor', 'official', 'policy') OR track = 'official' THEN 'official' ELSE 'media' END AS kind,
  CASE WHEN doc_id % 10 = 0 THEN 'origin' WHEN category IN ('vendor', 'research') OR coalesce(tier = 1, false) THEN 'official' WHEN category = 'aggregator' OR track = 'aggregator' THEN 'discussion' ELSE 'response' END AS development, count(*) AS n FROM j GROUP BY 1, 2""")
def q66_signal_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _registry(spark, sf_dir).withColumnRenamed("id", "source")
    j = signals(spark, sf_dir).select("source", "doc_id").join(F.broadcast(known), "source", "left")
    kind = registries.signal_kind(F.col("source"), F.col("role"), F.col("source_category"), F.col("track"))
    return j.groupBy(kind.alias("kind"), registries.development(F.col("source_category"), F.col("tier"), F.col("track"), F.col("doc_id") % 10 == 0).alias("development")).agg(F.count("*").alias("n"))


@query("""SELECT [NULL, 'agent-refactor', 'agent-refactor', 'infra-cost', NULL][c_custkey % 5 + 1] AS slug, count(*) AS n FROM customer GROUP BY 1""")
def q67_track_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that are known in either spelling, with spaces around them, or not at all."""
    name = F.expr("element_at(array('模型', 'Agent與軟體重構', ' Agent 與軟體重構 ', '基礎設施與成本', cast(null as string)), cast(c_custkey % 5 + 1 as int))")
    return table(spark, sf_dir, "customer").groupBy(registries.track_slug(name).alias("slug")).agg(F.count("*").alias("n"))


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderdate").cast("date")).alias("ingested"))
    rows = _gate_rows(spark, sf_dir).select("o_orderkey", "placeholder", events.blockers().alias("blockers"), F.expr("case o_orderstatus when 'O' then 'review' when 'F' then 'published' else 'dropped' end").alias("status"))
    return rows.join(days, "o_orderkey")


_QUEUE_SQL = f"""{_GATE_SQL}, q AS (SELECT k, codes, CASE b.o_orderstatus WHEN 'O' THEN 'review' WHEN 'F' THEN 'published' ELSE 'dropped' END AS status, k % 11 = 0 AS raw,
  CASE WHEN k % 9 > 0 THEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-09-01') END AS age FROM b JOIN orders ON k = o_orderkey),
w AS (SELECT *, len(codes) > 0 AND len(list_filter(codes, lambda c: c NOT IN ('missing_keywords', 'low_confidence', 'thin_by_policy'))) = 0 AS done FROM q)"""
_TERMINAL = ("missing_keywords", "low_confidence", "thin_by_policy")


@query(f"""WITH {_QUEUE_SQL} SELECT count(*) FILTER (status = 'published') AS published_total, count(*) FILTER (status = 'dropped') AS dropped_total, count(*) FILTER (status = 'review') AS review_total,
  count(*) FILTER (status = 'review' AND done) AS review_terminal, count(*) FILTER (status = 'review' AND NOT done) AS review_actionable, count(*) FILTER (status = 'review' AND raw) AS review_unenriched,
  coalesce(max(age) FILTER (status = 'review' AND raw), 0)::INT AS oldest_unenriched_days, coalesce(max(age) FILTER (status = 'review' AND NOT done), 0)::INT AS oldest_stuck_days,
  count(*) FILTER (status = 'review' AND age IS NULL) AS undated_review, count(*) FILTER (status = 'review' AND raw AND age IS NULL) AS unenriched_undated FROM w""")
def q68_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.review_queue(_queue(spark, sf_dir), F.lit("2001-09-01").cast("date"), _TERMINAL)


@query(f"WITH {_QUEUE_SQL} SELECT blocker, count(*) AS n FROM (SELECT unnest(codes) AS blocker FROM q WHERE status = 'review') GROUP BY blocker")
def q69_blocker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.blocker_counts(_queue(spark, sf_dir))


@query("""SELECT l_suppkey AS source_id, count(DISTINCT l_orderkey) AS bound, count(DISTINCT l_orderkey) FILTER (o_orderstatus = 'F') AS published
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY l_suppkey""")
def q70_bound_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event"), F.col("l_suppkey").alias("source_id"))
    own = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event"), F.expr("case o_orderstatus when 'F' then 'published' when 'P' then 'dropped' else 'review' end").alias("status"))
    return rollups.bound_by_source(ev, own)


@query("""WITH l AS (SELECT conv_id AS id, CASE WHEN role = 'user' THEN 'verdict' ELSE 'reason' END AS field, turn, length(text) AS n FROM conversations),
v AS (SELECT id, field, n, row_number() OVER (PARTITION BY id, field ORDER BY turn DESC) AS place FROM l),
p AS (SELECT id, max(CASE WHEN field = 'verdict' THEN CASE WHEN n % 3 = 0 THEN 'unanswerable' ELSE 'happened' END END) AS verdict, max(CASE WHEN field = 'reason' THEN 'r' || (n % 5) END) AS reason FROM v WHERE place = 1 GROUP BY id)
SELECT reason, count(*) AS demand, (SELECT count(*) FROM p WHERE verdict IS NOT NULL) AS answered, (SELECT count(*) FROM p WHERE verdict = 'unanswerable') AS unanswerable FROM p WHERE verdict = 'unanswerable' AND reason IS NOT NULL GROUP BY reason""")
def q71_answer_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    verdict = F.when(n % 3 == 0, "unanswerable").otherwise("happened")
    ledger = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("seq"), F.when(F.col("role") == "user", "verdict").otherwise("reason").alias("field"), F.when(F.col("role") == "user", verdict).otherwise(F.concat(F.lit("r"), n % 5)).alias("to")
    )
    return rollups.answer_tally(ledger)


@query("""WITH c AS (SELECT s_nationkey AS k, CASE s_suppkey % 3 WHEN 0 THEN 'official' WHEN 1 THEN 'independent' END AS kind FROM supplier WHERE s_nationkey % 4 <> 1 OR s_suppkey % 3 = 0)
SELECT n_nationkey AS capability, count(*) FILTER (kind = 'official') AS official, count(*) FILTER (kind = 'independent') AS independent, count(k) = 0 AS unclaimed,
  count(*) FILTER (kind = 'official') > 0 AND count(*) FILTER (kind = 'independent') = 0 AS official_only FROM nation LEFT JOIN c ON k = n_nationkey GROUP BY n_nationkey""")
def q72_coverage_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = table(spark, sf_dir, "supplier").filter("s_nationkey % 4 <> 1 or s_suppkey % 3 = 0").select(F.col("s_nationkey").alias("capability"), F.expr("case s_suppkey % 3 when 0 then 'official' when 1 then 'independent' end").alias("kind"))
    return rollups.coverage_sets(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("capability")), claims)


@query(f"WITH {_REGISTRY_SQL} SELECT coalesce(lifecycle, 'not filled in') AS value, count(*) AS n FROM r GROUP BY 1")
def q73_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.inventory(_registry(spark, sf_dir), "lifecycle")


@query("""WITH e AS (SELECT CAST(ts AS DATE) AS run, user_id, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, CASE WHEN event_id % 3 > 0 THEN event_id % 7 END AS items FROM events),
l AS (SELECT * FROM e WHERE run = (SELECT max(run) FROM e)) SELECT run, count(*) AS sources, coalesce(sum(items), 0)::BIGINT AS items,
  coalesce(array_to_string(list(user_id ORDER BY user_id) FILTER (status = 200 AND coalesce(items, 0) = 0), ','), '') AS zero_yield FROM l GROUP BY run""")
def q74_last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("run"), F.col("user_id").alias("source_id"), F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"), F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 7).alias("items")
    )
    return rollups.last_run(runs).withColumn("zero_yield", F.array_join("zero_yield", ","))


@query(f"WITH {_ROLLED_SQL} SELECT min(confidence) AS least, CAST(floor(median(confidence)) AS INT) AS median, max(confidence) AS most FROM c")
def q75_confidence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.summary(events.event_scores(_rolled(spark, sf_dir)), "confidence")


@query("""SELECT l_orderkey AS event, max(CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 2 ELSE 4 END)::INT AS code FROM lineitem GROUP BY l_orderkey""")
def q76_exit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("event")).agg(rollups.exit_code("l_returnflag", {"N": 0, "A": 2}).alias("code"))


@query("""WITH e AS (SELECT l_orderkey AS event, l_linenumber AS pos, CASE WHEN l_suppkey % 6 > 0 THEN l_shipdate END AS seen, CASE WHEN l_orderkey % 3 > 0 THEN 'observed' ELSE 'backfilled' END AS coverage FROM lineitem),
p AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY seen ASC NULLS LAST, pos) AS place, count(*) OVER (PARTITION BY event) > 1 AND coverage = 'observed' AS moves FROM e)
SELECT event, pos, place, CASE WHEN moves THEN 'course' ELSE 'evidence' END AS heading, moves AND place = 1 AND seen IS NOT NULL AS origin FROM p""")
def q77_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("event"), F.col("l_linenumber").alias("pos"), F.when(F.col("l_suppkey") % 6 > 0, F.col("l_shipdate")).alias("at"), F.when(F.col("l_orderkey") % 3 > 0, "observed").otherwise("backfilled").alias("coverage")
    )
    return rollups.course(ev).select("event", "pos", "place", "heading", "origin")


@query("SELECT l_suppkey AS source_id, l_returnflag AS kind, min(l_orderkey * 10 + l_linenumber) AS ord FROM lineitem GROUP BY 1, 2")
def q78_first_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source_id"), F.col("l_returnflag").alias("kind"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return rollups.first_of_each(rows, ["source_id", "kind"], "ord").select("source_id", "kind", "ord")


@query("""WITH e AS (SELECT p_partkey AS event, p_partkey * 7919 % 100003 AS ord, CASE WHEN p_partkey % 5 > 0 THEN p_size % 12 END AS track, p_brand || (p_partkey % 40) AS company FROM part),
p AS (SELECT a.event, b.event AS other, b.ord FROM e a JOIN e b ON (a.track = b.track OR a.company = b.company) AND a.event <> b.event),
r AS (SELECT event, other, row_number() OVER (PARTITION BY event ORDER BY ord, other) AS place FROM p) SELECT * FROM r WHERE place <= 4""")
def q79_related_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("event"), (F.col("p_partkey") * 7919 % 100003).alias("ord"), F.when(F.col("p_partkey") % 5 > 0, F.col("p_size") % 12).alias("track"), F.concat("p_brand", F.col("p_partkey") % 40).alias("company")
    )
    return rollups.related(e)


@query("""WITH d AS (SELECT p_brand AS company FROM part WHERE p_size < 4 GROUP BY 1), e AS (SELECT trim(CASE WHEN p_partkey % 6 = 0 THEN 'industry' WHEN p_partkey % 6 = 1 THEN ' ' ELSE p_brand || (p_partkey % 2) END) AS company FROM part),
n AS (SELECT company, count(*) AS n FROM e WHERE company NOT IN ('', 'industry') GROUP BY 1)
SELECT coalesce(d.company, n.company) AS company, d.company IS NOT NULL AS in_dictionary, coalesce(n, 0) AS events FROM (SELECT company || '0' AS company FROM d) d FULL OUTER JOIN n ON d.company = n.company""")
def q80_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    known = parts.filter("p_size < 4").select(F.concat("p_brand", F.lit("0")).alias("company"))
    named = parts.select(F.when(F.col("p_partkey") % 6 == 0, "industry").when(F.col("p_partkey") % 6 == 1, " ").otherwise(F.concat("p_brand", F.col("p_partkey") % 2)).alias("company"))
    return rollups.actors(known, named)


@query("""WITH c AS (SELECT p_partkey AS url, TIMESTAMP '1998-01-01' + to_hours(CAST(p_partkey * 31 % 20000 AS INT)) AS seen FROM part WHERE p_partkey % 10 < 4)
SELECT l_orderkey AS event, min(CAST(floor((epoch_us(seen) - epoch_us(o_orderdate)) / 86400000000.0) AS INT)) AS lead_days FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN c ON l_partkey = url GROUP BY 1""")
def q81_event_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("event"), F.col("l_partkey").alias("url"), F.col("o_orderdate").alias("happened"))
    seen = F.expr("timestampadd(HOUR, cast(p_partkey * 31 % 20000 as int), TIMESTAMP '1998-01-01 00:00:00')")
    return rollups.event_leads(ev, table(spark, sf_dir, "part").filter("p_partkey % 10 < 4").select(F.col("p_partkey").alias("url"), seen.alias("first_observed_at")))


@query("""WITH w AS (SELECT l_orderkey AS k, list_distinct(list(l_linenumber) FILTER (l_returnflag <> 'R')) AS want, list_distinct(list(l_linenumber) FILTER (l_linestatus = 'O')) AS got FROM lineitem GROUP BY 1)
SELECT k AS event, CASE WHEN got IS NOT NULL THEN array_to_string(list_sort(list_filter(coalesce(want, []), lambda x: NOT list_contains(got, x))), ',') END AS missing,
  CASE WHEN got IS NOT NULL THEN array_to_string(list_sort(list_filter(got, lambda x: NOT list_contains(coalesce(want, []), x))), ',') END AS extra FROM w""")
def q82_cell_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell that names no line at all counts as not filled in here."""
    cells = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("event")).agg(
        F.collect_list(F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))).alias("want"), F.collect_list(F.when(F.col("l_linestatus") == "O", F.col("l_linenumber"))).alias("got")
    )
    found = rollups.cell_differences(F.col("want"), F.when(F.size("got") > 0, F.col("got")))
    return cells.withColumn("d", found).select("event", F.array_join("d.missing", ",").alias("missing"), F.array_join("d.extra", ",").alias("extra"))


@query("""WITH n AS (SELECT c_nationkey AS k, count(*) % 5 AS signature FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) % 5 AS signature FROM supplier GROUP BY 1)
SELECT n.k AS track, n.signature FROM n LEFT JOIN b ON n.k = b.k WHERE n.signature IS DISTINCT FROM b.signature""")
def q83_dirty_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("track")).agg((F.count("*") % 5).alias("signature"))
    before = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("track")).agg((F.count("*") % 5).alias("signature"))
    return rollups.dirty(now, before, "track")


@query("""WITH s AS (SELECT user_id AS key, max(value) AS value, max(ts) AS ts FROM events WHERE event_type = 'view' GROUP BY 1), n AS (SELECT user_id AS key, sum(event_id)::DOUBLE AS value FROM events GROUP BY 1)
SELECT key, value, TIMESTAMP '2024-02-10' AS ts FROM n WHERE (SELECT max(ts) FROM s) <= TIMESTAMP '2024-02-10' - INTERVAL 12 HOUR UNION ALL SELECT key, value, ts FROM s WHERE (SELECT max(ts) FROM s) > TIMESTAMP '2024-02-10' - INTERVAL 12 HOUR""")
def q84_advanced_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    state = e.filter("event_type = 'view'").groupBy(F.col("user_id").alias("key")).agg(F.max("value").alias("value"), F.max("ts").alias("ts"))
    now = e.groupBy(F.col("user_id").alias("key")).agg(F.sum("event_id").cast("double").alias("value"))
    return rollups.advanced(state, now, F.lit("2024-02-10").cast("timestamp"), 12).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS ord, 'repo/' || l_partkey AS full_name, CASE WHEN l_quantity > 25 THEN 'An Awesome list' ELSE l_returnflag END AS description FROM lineitem)
SELECT full_name, min(ord) AS ord, arg_min(description, ord) AS description FROM r WHERE NOT contains(lower(full_name || ' ' || description), 'awesome') GROUP BY 1""")
def q85_found_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.concat(F.lit("repo/"), "l_partkey").alias("full_name"), F.when(F.col("l_quantity") > 25, "An Awesome list").otherwise(F.col("l_returnflag")).alias("description")
    )
    return rollups.found_once(found, ("awesome",))


_TEXTS = ("GPT mini 4 is out", "Gemini. Now 2 of them", "claude, at last, version 5", "agpt 4", "nothing at all 7", "Llama  herd of 3")


@query(f"WITH t AS (SELECT c_custkey % {len(_TEXTS)} AS k FROM customer) SELECT k IN (0, 2, 5) AS mentions, count(*) AS n FROM t GROUP BY 1")
def q86_version_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.element_at(F.array(*map(F.lit, _TEXTS)), (F.col("c_custkey") % len(_TEXTS) + 1).cast("int"))
    return table(spark, sf_dir, "customer").groupBy(text.mentions_version(t, ("claude", "gpt", "gemini", "llama")).alias("mentions")).agg(F.count("*").alias("n"))


_BODIES = ("待編輯", "done", "a todo here", "TBD", "Placeholder text", "fine")


@query(f"SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey % {len(_BODIES)} IN (1, 5) AND o_orderkey % 4 > 0 AND o_orderstatus <> 'P' GROUP BY 1")
def q87_ready_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a title, no placeholder, and not dropped."""
    body = F.element_at(F.array(*map(F.lit, _BODIES)), (F.col("o_orderkey") % len(_BODIES) + 1).cast("int"))
    title = F.when(F.col("o_orderkey") % 4 > 0, "a title").otherwise("  ")
    ready = table(spark, sf_dir, "orders").filter(~registries.has_placeholder(body) & (F.trim(title) != "") & (F.col("o_orderstatus") != "P"))
    return ready.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey % 4 + 1 AS share, count(*) AS n, sum(l_orderkey)::BIGINT AS total FROM lineitem GROUP BY 1""")
def q88_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ord"))
    out = None
    for k in range(1, 5):
        one = rollups.share_of(rows, k, 4).agg(F.lit(k).cast("long").alias("share"), F.count("*").alias("n"), F.sum("ord").alias("total"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT n_name AS name, ['Hacker News', 'OpenAI Blog', replace('The ' || n_name[1] || lower(n_name[2:]), '_', ' '), '來源'][n_nationkey % 4 + 1] AS shown FROM nation WHERE n_name NOT LIKE '% %'""")
def q89_source_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").filter("n_name not like '% %'")
    made = F.element_at(F.array(F.lit("src-hn"), F.lit("openai_blog"), F.concat(F.lit("the-"), F.col("n_name")), F.lit("")), (F.col("n_nationkey") % 4 + 1).cast("int"))
    return n.select(F.col("n_name").alias("name"), registries.source_name(made).alias("shown"))


@query("""WITH c AS (SELECT c_nationkey AS lane, count(*) AS n, count(DISTINCT c_mktsegment) AS tracks FROM customer GROUP BY 1) SELECT lane, n, tracks, row_number() OVER (ORDER BY n DESC, n_name) AS place FROM c JOIN nation ON lane = n_nationkey""")
def q90_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lanes by the number of their events, then by name; there are as many as nations."""
    from pyspark.sql import Window as W

    lanes = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("lane")).agg(F.count("*").alias("n"), F.count_distinct("c_mktsegment").alias("tracks"))
    named = lanes.join(F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("lane"), "n_name")), "lane")
    return named.select("lane", "n", "tracks", F.row_number().over(W.orderBy(F.desc("n"), "n_name")).alias("place"))


_DATED = ("July 24, 2026", "July 2026", "Sept 3", " jul. 4th 2026 ", "July 30, 2026: retired", "from July 30, 2026", "2026-07-24", "", "May", "24 July 2026")


@query(f"WITH t AS (SELECT c_custkey % {len(_DATED) + 1} AS k FROM customer) SELECT k < 4 AS only_date, count(*) AS n FROM t GROUP BY 1")
def q91_date_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are a date as a whole; the last of them is null."""
    t = F.element_at(F.array(*map(F.lit, _DATED), F.lit(None).cast("string")), (F.col("c_custkey") % (len(_DATED) + 1) + 1).cast("int"))
    return table(spark, sf_dir, "customer").groupBy(dates.is_date_only(t).alias("only_date")).agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT o_custkey AS page, CAST(o_orderdate AS DATE) + INTERVAL 3653 DAY AS day, o_orderkey % 3 > 0 AS marked FROM orders)
SELECT page, count(DISTINCT day) FILTER (marked)::INT AS anchor_dates, count(DISTINCT day)::INT AS text_dates, (count(DISTINCT day) - count(DISTINCT day) FILTER (marked))::INT AS orphan_dates FROM d GROUP BY page""")
def q92_anchor_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of dated entries, two thirds of which have an anchor; days stand ten years later, as only years from 2000 count."""
    day = F.date_add(F.col("o_orderdate").cast("date"), 3653)
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), F.date_format(day, "MMMM d, yyyy").alias("shown"), F.when(F.col("o_orderkey") % 3 > 0, F.date_format(day, "MMMM-d-yyyy")).alias("anchor"))
    told = rows.groupBy("page").agg(F.collect_set("anchor").alias("anchors"), F.array_join(F.collect_list(F.concat("shown", F.lit(": an entry. "))), "").alias("shown"))
    return told.withColumn("g", dates.anchor_gap(F.col("anchors"), F.col("shown"))).select("page", "g.*")


@query("""SELECT s_nationkey AS source_id, CASE WHEN s_nationkey % 2 = 0 THEN 'rss' ELSE 'atom' END AS dialect, count(*)::INT AS items, count(*)::INT AS title, (count(*) FILTER (s_suppkey % 3 > 0))::INT AS link,
  (count(*) FILTER (s_suppkey % 5 > 0))::INT AS date, (count(*) FILTER (s_suppkey % 4 > 0))::INT AS guid, (count(*) FILTER (s_suppkey % 7 > 0))::INT AS author,
  count(*) FILTER (s_suppkey % 3 > 0) < count(*) AND count(*) FILTER (s_suppkey % 4 > 0) > count(*) FILTER (s_suppkey % 3 > 0) AS link_fallback_needed FROM supplier GROUP BY s_nationkey""")
def q93_feed_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds in two dialects with fields that are missing or blank."""
    k, atom = F.col("s_suppkey"), F.col("s_nationkey") % 2 == 1

    def field(rss: str, own: str, value: F.Column, has: F.Column, inner: str = "") -> F.Column:
        open_, close = (f"<{inner}>", f"</{inner}>") if inner else ("", "")
        text_ = F.when(has, value).when(k % 2 == 0, "  ")
        named = F.when(atom, F.concat(F.lit(f"<{own}>{open_}"), text_, F.lit(f"{close}</{own}>"))).otherwise(F.concat(F.lit(f"<{rss}>"), text_, F.lit(f"</{rss}>")))
        return F.coalesce(named, F.lit(""))

    key = k.cast("string")
    item = F.concat(
        F.concat(F.lit("<title>"), "s_name", F.lit("</title>")), field("link", "link", F.concat(F.lit("https://e.org/"), key), k % 3 > 0), field("pubDate", "updated", F.lit("2026-07-24"), k % 5 > 0), field("guid", "id", key, k % 4 > 0),
        field("dc:creator", "author", F.lit("A. Writer"), k % 7 > 0, "name"),
    )
    items = F.array_join(F.collect_list(F.when(atom, F.concat(F.lit("<entry>"), item, F.lit("</entry>"))).otherwise(F.concat(F.lit("<item>"), item, F.lit("</item>")))), "")
    feeds = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(items.alias("items"))
    body = F.when(F.col("s_nationkey") % 2 == 1, F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), "items", F.lit("</feed>"))).otherwise(
        F.concat(F.lit('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>'), "items", F.lit("</channel></rss>"))
    )
    return pages.inspect_feeds(feeds.select(F.col("s_nationkey").alias("source_id"), body.alias("body"))).drop("error")


@query("""SELECT 'p' || p_partkey AS name, CASE WHEN p_partkey % 11 > 0 THEN p_name END AS text FROM part WHERE p_partkey % 4 = 1 OR (p_partkey % 4 = 2 AND p_partkey % 11 > 0)""")
def q94_changed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store that lacks a quarter of the pages and has other words in a quarter of them."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    now = p.select(F.concat(F.lit("p"), k).alias("name"), F.when(k % 11 > 0, F.col("p_name")).alias("text"))
    before = p.filter(k % 4 != 1).select(F.concat(F.lit("p"), k).alias("name"), F.when(k % 11 > 0, F.concat("p_name", F.when(k % 4 == 2, "!").otherwise(""))).alias("text"))
    return export.changed_pages(now, before)


# Months as the anchors of release pages have them, in full or short.
_ANCHOR_MONTHS = ("jan", "february", "march", "apr", "may", "june", "july", "aug", "sept", "october", "nov", "december")


@query(f"""WITH {SIGNALS}, d AS (SELECT *, trim(regexp_replace(regexp_replace(title, '[<>&]', '', 'g'), '[\\s]+', ' ', 'g')) AS entry, row_number() OVER (PARTITION BY doc_id // 8 ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY doc_id // 8) AS of FROM signals)
SELECT doc_id // 8 AS page_id, make_date(2020 + doc_id % 6, doc_id % 12 + 1, doc_id % 28 + 1)::VARCHAR AS date, entry AS text, k = of AS tail FROM d WHERE entry <> ''""")
def q96_release_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release pages of eight titles each, under anchors in full and short months, with menus, links and dates between them."""
    k, months = F.col("doc_id"), F.array(*[F.lit(m) for m in _ANCHOR_MONTHS])
    anchor = F.concat_ws("-", F.get(months, k % 12), F.concat(k % 28 + 1, F.when(k % 3 == 0, "th").otherwise("")), 2020 + k % 6)
    entry = F.regexp_replace("title", "[<>&]", "")
    part = F.concat(
        F.lit('<h3><div id="'), anchor, F.lit('">h</div></h3><link rel="x"><nav><ul><li>Docs</li></ul></nav><ul><li class="a"><b>'), entry, F.lit("</b></li><li>July 23</li></ul><aside>One may subscribe to this page by mail or by a feed.</aside>")
    )
    parts = F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), part.alias("part")))), lambda x: x["part"])
    made = signals(spark, sf_dir).groupBy(F.floor(k / 8).alias("page_id")).agg(F.concat(F.lit("<title>t</title>"), F.array_join(parts, ""), F.lit("<footer><li>Home</li></footer>")).alias("html"))
    return pages.release_notes(made).select("page_id", F.col("date").cast("string").alias("date"), "text", "tail")
