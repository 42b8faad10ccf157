"""Queries on signals and titles: quality, tokens, identity, pairs, clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import events, ledgers, quality, similarity
from tidemark.plans.base import SCORED, SIGNALS, TITLED, query, signals, sql_facet, sql_fingerprint, sql_jaccard, sql_tokens, table, titles


@query(f"WITH {SCORED} SELECT doc_id, role, authority, richness, freshness, originality, completeness, total, grade FROM scored WHERE total >= 40")
def q01_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality.score(signals(spark, sf_dir)).filter(F.col("total") >= quality.DISCARD_BELOW)
    return kept.select("doc_id", "role", "authority", "richness", "freshness", "originality", "completeness", "total", "grade")


@query(f"WITH {SCORED} SELECT grade, count(*) AS n, count(*) FILTER (total < 40) AS discarded FROM scored GROUP BY grade")
def q02_grade_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(signals(spark, sf_dir)).groupBy("grade").agg(F.count("*").alias("n"), F.count_if(F.col("total") < quality.DISCARD_BELOW).alias("discarded"))


@query(f"WITH {SCORED} SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM scored) GROUP BY flag")
def q03_flag_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(signals(spark, sf_dir)).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query(f"WITH {SCORED} SELECT doc_id, lead_days FROM scored WHERE coalesce(lead_days <= 7, true)")
def q04_recency_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = signals(spark, sf_dir).withColumn("lead_days", dates.floor_days(F.col("first_observed_at"), F.col("published")))
    return s.filter(quality.recent(F.col("lead_days"))).select("doc_id", "lead_days")


@query(f"""WITH {SIGNALS} SELECT track, count(*) AS n, count(author) AS with_author, count(*) FILTER (n_tags > 0) AS with_entities,
  round(count(author) * 1.0 / count(*), 4) AS author_ratio FROM signals GROUP BY track""")
def q05_track_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = signals(spark, sf_dir).groupBy("track").agg(F.count("*").alias("n"), F.count("author").alias("with_author"), F.count_if(F.col("n_tags") > 0).alias("with_entities"))
    return made.withColumn("author_ratio", F.round(F.try_divide(F.col("with_author").cast("double"), F.col("n")), 4))


@query(f"WITH {SIGNALS} SELECT doc_id, array_to_string(list_sort({sql_tokens('title')}), ' ') AS tokens FROM signals")
def q06_title_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(text.title_tokens(text.fold(F.col("title"), True))), " ").alias("tokens"))


_KEYWORD_SQL = ", ".join(f"'{w}'" for w in text.KEYWORD_STOP_WORDS)


@query(f"""WITH {SIGNALS}, w AS (
  SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(title), '[^a-z0-9一-鿿]+', ' ', 'g')), ' '),
    lambda w: length(w) > 1 AND NOT regexp_full_match(w, '[0-9]+') AND w NOT IN ({_KEYWORD_SQL})) AS ws FROM signals
) SELECT doc_id, array_to_string(list_filter(ws, lambda w, i: list_position(ws, w) = i)[1:8], ' ') AS keywords FROM w""")
def q07_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("doc_id", F.array_join(text.keywords(text.fold(F.col("title"), True)), " ").alias("keywords"))


@query(f"WITH {TITLED} SELECT p_partkey, {sql_fingerprint('title')} AS fingerprint FROM titled")
def q08_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).select("p_partkey", text.fingerprint(text.fold(F.col("title"), True)).alias("fingerprint"))


@query(f"WITH {TITLED} SELECT facet, CASE facet WHEN 'update' THEN 'release' WHEN 'benchmark' THEN 'capability' ELSE facet END AS bucket, count(*) AS n FROM (SELECT {sql_facet('title')} AS facet FROM titled) GROUP BY 1, 2")
def q09_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = titles(spark, sf_dir).select(text.facet(text.fold(F.col("title"), True)).alias("facet"))
    return found.withColumn("bucket", text.facet_bucket(F.col("facet"))).groupBy("facet", "bucket").agg(F.count("*").alias("n"))


@query(f"""WITH {SIGNALS}, t AS (SELECT doc_id, source, published, {sql_tokens('title')} AS tk FROM signals WHERE published IS NOT NULL)
SELECT a.doc_id AS a, b.doc_id AS b, round({sql_jaccard('a.tk', 'b.tk')}, 6) AS similarity FROM t a JOIN t b ON a.source = b.source AND a.doc_id < b.doc_id
WHERE abs(epoch_us(a.published) - epoch_us(b.published)) <= 96 * 3600000000 AND {sql_jaccard('a.tk', 'b.tk')} >= 0.30""")
def q10_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar titles of one source within 96 hours."""
    s = signals(spark, sf_dir).select(F.col("doc_id").alias("id"), "source", F.col("published").alias("at"), text.title_tokens(text.fold(F.col("title"), True)).alias("tokens"))
    pairs = similarity.similar_pairs(s, s, events.SIMILAR, by=("source",), hours=events.BY_TITLE_HOURS, once=True)
    return pairs.select(F.col("left").alias("a"), F.col("right").alias("b"), F.round("similarity", 6).alias("similarity"))


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titled parts as evidence: an event is a brand and a week, the language follows the key."""
    t = events.keyed(titles(spark, sf_dir), True)
    return t.select(
        F.col("p_partkey").alias("node"), F.concat_ws(":", "p_brand", F.weekofyear("at")).alias("event"), F.expr("element_at(array('en', 'zh', ''), cast(p_partkey % 3 + 1 as int))").alias("lang"),
        "at", "fp", "tokens", F.array_distinct(F.array(F.col("fp"), (F.col("p_partkey") % 2).cast("string"))).alias("entities"), (F.col("p_partkey") % 4).cast("int").alias("tier"), F.col("p_partkey").alias("pos"),
    )


_EVIDENCE_SQL = f"""{TITLED}, ev AS (
  SELECT p_partkey AS node, p_brand || ':' || weekofyear(seen) AS event, ['en', 'zh', ''][p_partkey % 3 + 1] AS lang, seen, {sql_fingerprint('title')} AS fp, {sql_tokens('title')} AS tokens,
    p_partkey % 4 AS tier FROM titled
), e2 AS (SELECT *, list_distinct([coalesce(fp, chr(0)), CAST(node % 2 AS VARCHAR)]) AS entities FROM ev)"""
_REPOST_SQL = """, g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), r AS (
  SELECT node, node AS reached FROM ev UNION SELECT r.node, g.b FROM r JOIN g ON r.reached = g.a
), c AS (SELECT node, min(reached) AS story FROM r GROUP BY node)
SELECT e.event, e.node, c.story FROM ev e JOIN c USING (node)
QUALIFY row_number() OVER (PARTITION BY e.event, c.story ORDER BY e.seen, e.tier, e.node) > 1"""


@query(f"""WITH RECURSIVE {_EVIDENCE_SQL}, l AS (
  SELECT x.node AS a, y.node AS b FROM e2 x JOIN e2 y ON x.event = y.event AND x.node < y.node
  WHERE abs(epoch_us(x.seen) - epoch_us(y.seen)) <= 168 * 3600000000 AND {sql_jaccard('x.tokens', 'y.tokens')} >= 0.95
){_REPOST_SQL}""".replace("SELECT e.event, e.node, c.story", "SELECT e.event, e.node"))
def q11_verbatim_reposts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.reposts(_evidence(spark, sf_dir), "verbatim").filter("suspected_repost").select("event", "node")


@query(f"""WITH RECURSIVE {_EVIDENCE_SQL}, l AS (
  SELECT x.node AS a, y.node AS b FROM e2 x JOIN e2 y ON x.event = y.event AND x.node < y.node
  WHERE x.lang <> y.lang AND x.lang <> '' AND y.lang <> '' AND abs(epoch_us(x.seen) - epoch_us(y.seen)) <= 48 * 3600000000 AND coalesce(x.fp = y.fp, true)
    AND {sql_jaccard('x.entities', 'y.entities')} >= 0.8
){_REPOST_SQL}""".replace("SELECT e.event, e.node, c.story", "SELECT e.event, e.node"))
def q12_cross_lang_reposts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _evidence(spark, sf_dir).withColumn("entities", F.array_distinct(F.array(F.coalesce("fp", F.lit("\0")), (F.col("node") % 2).cast("string"))))
    return events.reposts(ev, "translated").filter("suspected_repost").select("event", "node")


@query("""WITH RECURSIVE ev AS (
  SELECT l_orderkey AS event, l_orderkey * 100000000 + l_partkey * 10000 + l_suppkey AS node, l_suppkey, CASE WHEN l_suppkey % 3 > 0 THEN s_nationkey END AS media_group, CASE WHEN l_partkey % 4 = 0 THEN l_partkey % 50 END AS person
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
), a AS (
  SELECT event, node, 'g' || media_group AS anchor FROM ev WHERE media_group IS NOT NULL UNION SELECT event, node, 'p' || person FROM ev WHERE person IS NOT NULL
  UNION SELECT event, node, 's' || l_suppkey FROM ev WHERE media_group IS NULL AND person IS NULL
), g AS (SELECT DISTINCT x.node AS a, y.node AS b FROM a x JOIN a y ON x.event = y.event AND x.anchor = y.anchor), r AS (
  SELECT event, node, node AS reached FROM ev UNION SELECT r.event, r.node, g.b FROM r JOIN g ON r.reached = g.a
) SELECT event, CAST(count(DISTINCT root) AS INT) AS voices FROM (SELECT event, node, min(reached) AS root FROM r GROUP BY event, node) GROUP BY event""")
def q13_independent_voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("event"), (F.col("l_orderkey") * 100_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey")).alias("node"), F.col("l_suppkey").cast("string").alias("source_id"),
        F.when(F.col("l_suppkey") % 3 > 0, F.col("s_nationkey").cast("string")).alias("media_group"), F.when(F.col("l_partkey") % 4 == 0, (F.col("l_partkey") % 50).cast("string")).alias("person_id"),
    )
    return events.independent_voices(ev)


_MATCH_SQL = f"""{TITLED}, k AS (
  SELECT p_partkey, seen, {sql_fingerprint('title')} AS fp, {sql_facet('title')} AS facet, {sql_tokens('title')} AS tk FROM titled
), kb AS (SELECT *, CASE facet WHEN 'update' THEN 'release' WHEN 'benchmark' THEN 'capability' ELSE facet END AS bucket FROM k), m AS (
  SELECT s.p_partkey AS signal, e.p_partkey AS event, coalesce(s.fp = e.fp, false) AS same_fp, s.bucket = e.bucket AS same_bucket, round({sql_jaccard('s.tk', 'e.tk')}, 6) AS similarity
  FROM kb s JOIN kb e ON s.seen >= TIMESTAMP '2024-01-01 09:00:00' AND e.seen < TIMESTAMP '2024-01-01 09:00:00' AND abs(epoch_us(s.seen) - epoch_us(e.seen)) <= 504 * 3600000000
  WHERE CASE WHEN s.fp <> e.fp THEN false
    WHEN s.fp = e.fp THEN s.bucket = e.bucket AND abs(epoch_us(s.seen) - epoch_us(e.seen)) <= (CASE s.bucket WHEN 'incident' THEN 168 ELSE 504 END) * 3600000000
    ELSE abs(epoch_us(s.seen) - epoch_us(e.seen)) <= 96 * 3600000000 AND {sql_jaccard('s.tk', 'e.tk')} >= 0.30 END
)"""


@query(f"""WITH {_MATCH_SQL}, p AS (SELECT *, rank() OVER (PARTITION BY signal ORDER BY same_fp DESC, same_bucket DESC, similarity DESC) AS place FROM m)
SELECT signal, any_value(event) AS event, CAST(round_even(100 * any_value(similarity), 0) AS INT) AS relevance FROM p WHERE place = 1 GROUP BY signal HAVING count(*) = 1""")
def q14_attach_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = titles(spark, sf_dir)
    # what was there in the first hours are the known events: a fixed share of all rows
    late, known = made.filter("at >= '2024-01-01 09:00:00'").withColumnRenamed("p_partkey", "signal"), made.filter("at < '2024-01-01 09:00:00'").withColumnRenamed("p_partkey", "event")
    return events.attach_best(late, known, ascii_only=True).select("signal", "event", F.bround(100 * F.col("similarity")).cast("int").alias("relevance"))


#: Signals one after the other, the list of leaders so far as the state.
_LEADERS_SQL = f"""WITH RECURSIVE {TITLED}, k AS MATERIALIZED (
  SELECT p_partkey AS id, seen, {sql_fingerprint('title')} AS fp, {sql_facet('title')} AS facet, {sql_tokens('title')} AS tk, p_partkey * 7 % 101 AS ev FROM titled
), kb AS MATERIALIZED (SELECT *, CASE facet WHEN 'update' THEN 'release' WHEN 'benchmark' THEN 'capability' ELSE facet END AS bucket, row_number() OVER (ORDER BY ev DESC, id) AS turn FROM k), m AS MATERIALIZED (
  SELECT s.id AS signal, s.turn, s.ev, e.id AS event, e.turn AS e_turn, coalesce(s.fp = e.fp, false)::INT * 4 + (s.bucket = e.bucket)::INT * 2 + round({sql_jaccard('s.tk', 'e.tk')}, 6) AS rank
  FROM kb s JOIN kb e ON e.ev >= 70 AND s.id <> e.id AND e.turn < s.turn AND abs(epoch_us(s.seen) - epoch_us(e.seen)) <= 504 * 3600000000
  WHERE CASE WHEN s.fp <> e.fp THEN false
    WHEN s.fp = e.fp THEN s.bucket = e.bucket AND abs(epoch_us(s.seen) - epoch_us(e.seen)) <= (CASE s.bucket WHEN 'incident' THEN 168 ELSE 504 END) * 3600000000
    ELSE abs(epoch_us(s.seen) - epoch_us(e.seen)) <= 96 * 3600000000 AND {sql_jaccard('s.tk', 'e.tk')} >= 0.30 END
), near AS MATERIALIZED (
  SELECT turn, list(struct_pack(rank := rank, event := event) ORDER BY rank DESC, event) AS near FROM m WHERE ev >= 70 GROUP BY turn
), o AS MATERIALIZED (
  SELECT kb.turn, id, coalesce(near, []) AS near FROM kb LEFT JOIN near USING (turn) WHERE ev >= 70
), r AS (
  SELECT 0::BIGINT AS n, []::BIGINT[] AS leaders
  UNION ALL
  SELECT n + 1, CASE WHEN len(b) > 0 AND (len(b) = 1 OR b[1].rank > b[2].rank) THEN leaders ELSE list_append(leaders, id) END
  FROM (SELECT n, leaders, o.id, list_filter(o.near, lambda x: list_contains(leaders, x.event)) AS b FROM r JOIN o ON o.turn = r.n + 1)
), l AS (
  SELECT unnest(leaders) AS id FROM (SELECT leaders FROM r ORDER BY n DESC LIMIT 1)
), p AS (
  SELECT signal, event, rank() OVER (PARTITION BY signal ORDER BY rank DESC) AS place FROM m WHERE event IN (SELECT id FROM l) AND signal NOT IN (SELECT id FROM l)
), a AS (
  SELECT signal, any_value(event) AS event FROM p WHERE place = 1 GROUP BY signal HAVING count(*) = 1
)
SELECT id AS signal, CASE WHEN id IN (SELECT id FROM l) THEN id ELSE a.event END AS event, CASE WHEN id IN (SELECT id FROM l) THEN 'opened' WHEN a.event IS NULL THEN 'deferred' ELSE 'attached' END AS state
FROM kb LEFT JOIN a ON a.signal = kb.id"""


@query(_LEADERS_SQL)
def q15_leader_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequential by nature, settled in rounds."""
    s = titles(spark, sf_dir).select(F.col("p_partkey").alias("signal"), "title", "at", (F.col("p_partkey") * 7 % 101).cast("int").alias("eventability"), F.col("p_partkey").alias("order"))
    return events.lead_events(s)


_ROLLED_SQL = """e AS (
  SELECT o_orderkey AS event, max(CASE l_suppkey % 4 WHEN 1 THEN 90 WHEN 2 THEN 65 WHEN 3 THEN 40 ELSE 50 END) AS authority, count(*) FILTER (l_returnflag = 'R') AS primary_count,
    count(DISTINCT l_suppkey) AS voices, (epoch_us(TIMESTAMP '2001-09-01') - epoch_us(max(o_orderdate))) / 3600000000.0 % 500 AS age_hours
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey
), c AS (
  SELECT *, CAST(least(100, round_even(authority * 0.62 + least(voices, 4) * 7 + least(primary_count, 2) * 10, 0)) AS INT) AS confidence,
    CAST(greatest(0, least(100, round_even(100 * exp(-greatest(0, age_hours) / 96), 0))) AS INT) AS freshness FROM e
)"""


@query(f"WITH {_ROLLED_SQL} SELECT event, authority, voices, confidence, freshness, CAST(NULL AS INT) AS heat, CAST(round_even(confidence * 0.40 + 55 * 0.40 + freshness * 0.20, 0) AS INT) AS value FROM c")
def q16_event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.event_scores(_rolled(spark, sf_dir)).select("event", "authority", "voices", "confidence", "freshness", "heat", "value")


def _rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events, their lines as evidence; grouped on the order's key, by which both tables are joined."""
    both = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.groupBy(F.col("o_orderkey").alias("event")).agg(
        F.max(quality.tier_authority(F.col("l_suppkey") % 4)).alias("authority"), F.count_if(F.col("l_returnflag") == "R").alias("primary_count"),
        F.count_distinct("l_suppkey").alias("voices"), (F.expr("(unix_micros(TIMESTAMP '2001-09-01') - unix_micros(cast(max(o_orderdate) as timestamp))) / 3600000000") % 500).alias("age_hours"),
    )


@query("""SELECT l_orderkey AS event, CASE WHEN count(*) = count(CASE WHEN l_suppkey % 20 > 0 THEN l_shipdate END) THEN min(l_shipdate) END AS observable_from,
  CASE WHEN count(*) <> count(CASE WHEN l_suppkey % 20 > 0 THEN 1 END) THEN 'unknown' WHEN any_value(o_orderdate) + INTERVAL 30 DAY >= min(l_shipdate) THEN 'observed' ELSE 'backfilled' END AS coverage
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey""")
def q17_coverage_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event"), F.when(F.col("l_suppkey") % 20 > 0, F.col("l_shipdate")).alias("first_fetch"))
    seen = events.observable_from(ev).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event"), F.expr("o_orderdate + INTERVAL 30 DAY").alias("happened")), "event")
    return seen.select("event", "observable_from", events.coverage_state(F.col("happened"), F.col("observable_from")).alias("coverage"))


@query("""SELECT l_orderkey AS event, min(CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0) AS INT)) AS lead_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey""")
def q18_event_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.groupBy(F.col("l_orderkey").alias("event")).agg(F.min(dates.floor_days(F.col("l_shipdate"), F.col("o_orderdate"))).alias("lead_days"))


def _gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.select(
        "o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 11 == 0).alias("placeholder"), (F.col("o_orderkey") % 50).alias("fact_chars"), F.length("c_name").alias("summary_chars"),
        F.expr("element_at(array('has_text', 'unfetched', 'withheld'), cast(o_orderkey % 3 + 1 as int))").alias("thin"),
        F.expr("element_at(array('research', 'industry', 'vendor', ''), cast(o_custkey % 4 + 1 as int))").alias("category"), (F.col("o_orderkey") % 90).alias("impact_chars"),
        (F.col("o_orderkey") % 70).alias("context_chars"), F.when(F.col("c_mktsegment") == "MACHINERY", " Unknown ").otherwise(F.col("c_mktsegment")).alias("company"), (F.col("o_orderkey") % 4).alias("n_keywords"),
        F.when(F.col("o_orderkey") % 6 > 0, "models").alias("track"), (F.col("o_orderkey") % 5).alias("n_evidence"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey") % 3).alias("primary_evidence"),
        F.floor(F.col("o_totalprice") % 100).cast("int").alias("confidence"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 100).alias("heat"), (F.col("o_orderkey") % 3).alias("signals"),
        (F.col("o_orderkey") % 4).alias("voices"), (F.col("o_orderkey") % 3).alias("platforms"), (F.col("o_orderkey") % 12).cast("int").alias("lead_days"),
    )


_GATE_SQL = """g AS (
  SELECT o_orderkey AS k, o_orderstatus, o_orderkey % 50 AS fact, length(c_name) AS summary, ['thin_fact', 'thin_unfetched', 'thin_by_policy'][o_orderkey % 3 + 1] AS thin,
    ['research', 'industry', 'vendor', ''][o_custkey % 4 + 1] AS category, c_mktsegment AS seg, CAST(floor(o_totalprice % 100) AS INT) AS conf FROM orders JOIN customer ON o_custkey = c_custkey
), b AS (
  SELECT k, o_orderstatus, list_filter([CASE WHEN k % 11 = 0 THEN 'placeholder_content' END, CASE WHEN fact < 20 OR summary < 20 THEN thin END,
    CASE WHEN category = 'research' AND (k % 90 < 40 OR k % 70 < 30) THEN 'thin_research_analysis' END, CASE WHEN seg = 'MACHINERY' THEN 'generic_entity' END,
    CASE WHEN category IN ('', 'industry') THEN 'missing_category' END, CASE WHEN k % 4 = 0 THEN 'missing_keywords' END, CASE WHEN k % 6 = 0 THEN 'missing_track' END,
    CASE WHEN k % 5 = 0 THEN 'missing_evidence' END, CASE WHEN k % 7 = 0 OR k % 3 = 0 THEN 'missing_primary_evidence' END, CASE WHEN conf < 60 THEN 'low_confidence' END,
    CASE WHEN k % 2 = 0 AND k % 3 <= 0 THEN 'unmeasured_heat' END, CASE WHEN k % 2 = 0 AND k % 100 >= 70 AND (k % 4 < 2 OR k % 3 < 2) THEN 'unsupported_heat' END], lambda x: x IS NOT NULL) AS codes FROM g
)"""


@query(f"WITH {_GATE_SQL} SELECT k AS o_orderkey, array_to_string(codes, ',') AS blockers FROM b")
def q19_gate_blockers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate_rows(spark, sf_dir).select("o_orderkey", F.array_join(events.blockers(), ",").alias("blockers"))


@query(f"""WITH {_GATE_SQL}, s AS (SELECT CASE o_orderstatus WHEN 'O' THEN 'review' WHEN 'F' THEN 'published' ELSE 'dropped' END AS status, len(codes) AS n, k % 12 AS lead FROM b)
SELECT status, CASE WHEN status = 'dropped' THEN status WHEN lead > 7 THEN 'review' WHEN status = 'review' AND n = 0 THEN 'published' ELSE status END AS next_status, count(*) AS n FROM s GROUP BY 1, 2""")
def q20_status_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gate_rows(spark, sf_dir).withColumns({"codes": events.blockers(), "status": F.expr("case o_orderstatus when 'O' then 'review' when 'F' then 'published' else 'dropped' end")})
    return rows.withColumn("next_status", events.next_status(F.col("status"), F.col("codes"), F.col("lead_days"))).groupBy("status", "next_status").agg(F.count("*").alias("n"))


@query(f"""WITH {_GATE_SQL}, s AS (
  SELECT CASE o_orderstatus WHEN 'O' THEN 'review' WHEN 'F' THEN 'published' ELSE 'dropped' END AS status, codes, k % 12 > 7 AS stale, CASE WHEN k % 3 = 0 THEN ['thin_fact'] ELSE [] END AS had FROM b
), h AS (
  SELECT status, CASE status WHEN 'review' THEN codes ELSE had END || CASE WHEN stale AND status <> 'dropped' THEN ['stale_backfill'] ELSE [] END AS codes FROM s
) SELECT status, code, count(*) AS n FROM (SELECT status, unnest(codes) AS code FROM h) GROUP BY status, code""")
def q95_gate_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each code is among the blockers that the gate leaves."""
    rows = _gate_rows(spark, sf_dir).withColumns({"codes": events.blockers(), "status": F.expr("case o_orderstatus when 'O' then 'review' when 'F' then 'published' else 'dropped' end")})
    had = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("thin_fact")))
    left = events.gate_codes(F.col("status"), F.col("codes"), had, F.col("lead_days"))
    return rows.select("status", F.explode(left).alias("code")).groupBy("status", "code").agg(F.count("*").alias("n"))


@query(f"""WITH {SIGNALS}, a AS (SELECT source, CASE WHEN trim(CASE WHEN doc_id % 4 = 0 THEN summary ELSE '' END) <> '' THEN 'has_text' WHEN n = 7 THEN 'unfetched' WHEN n % 4 = 1 THEN 'withheld' WHEN n % 4 = 2 THEN 'unfetched' ELSE 'withheld' END AS state FROM signals)
SELECT source, count(*) FILTER (state = 'has_text') AS has_text, count(*) FILTER (state = 'unfetched') AS unfetched, count(*) FILTER (state = 'withheld') AS withheld,
  count(*) FILTER (state = 'withheld') > 0 AS needs_source_link, CASE WHEN bool_or(state = 'has_text') THEN 'has_text' WHEN bool_or(state = 'unfetched') THEN 'unfetched' ELSE 'withheld' END AS thin_reason FROM a GROUP BY source""")
def q21_thin_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = signals(spark, sf_dir)
    note = F.when(F.col("n") % 4 == 1, "ai-input=no").when(F.col("n") % 4 == 2, "excerpt").otherwise("title and link")
    state = events.availability(F.col("n") != 7, F.when(F.col("doc_id") % 4 == 0, F.col("summary")), note, F.lit(False))
    counts = [F.count_if(F.col("state") == x).alias(x) for x in ("has_text", "unfetched", "withheld")]
    return s.withColumn("state", state).groupBy("source").agg(*counts, (F.count_if(F.col("state") == "withheld") > 0).alias("needs_source_link"), events.thin_reason("state").alias("thin_reason"))


@query(f"WITH {SIGNALS}, p AS (SELECT doc_id, [CASE WHEN tier = 1 THEN 25 WHEN tier = 2 THEN 10 ELSE 0 END, CASE WHEN role = 'primary' THEN 20 WHEN role = 'research' THEN 10 ELSE 0 END, CASE WHEN category IN ('vendor', 'research') THEN 15 ELSE 0 END] AS parts, role, category, title, summary FROM signals) SELECT doc_id, CAST(CASE WHEN role = 'aggregator' THEN 0 ELSE least(list_sum(parts) + CASE WHEN regexp_matches(title, '{quality.ANNOUNCES}') THEN 20 ELSE 0 END + CASE WHEN {sql_fingerprint('title')} IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN role = 'research' AND length(trim(summary)) >= 160 AND regexp_matches(title || ' ' || summary, '{quality.CONTRIBUTES}') AND regexp_matches(title || ' ' || summary, '{quality.DECIDES}') THEN 25 ELSE 0 END, CASE WHEN role = 'research' AND NOT (length(trim(summary)) >= 160 AND regexp_matches(title || ' ' || summary, '{quality.CONTRIBUTES}') AND regexp_matches(title || ' ' || summary, '{quality.DECIDES}')) THEN 65 ELSE 100 END) END AS INT) AS eventability FROM p")
def q61_eventability(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = signals(spark, sf_dir)
    points = quality.eventability(F.col("title"), F.col("summary"), F.col("role"), F.col("category"), F.col("tier"), F.lit(None).cast("int"))
    return s.select("doc_id", points.alias("eventability"))


@query(f"""WITH {SIGNALS}, k AS (SELECT source, unnest(list_distinct(string_split(lower(title), ' '))) AS candidate FROM signals)
SELECT candidate, count(*) AS hits, count(DISTINCT source) AS sources FROM k WHERE length(candidate) > 3 GROUP BY candidate HAVING count(*) >= 3 AND count(DISTINCT source) >= 2""")
def q35_dict_tally_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tallied(spark, sf_dir).filter((F.col("hits") >= ledgers.MIN_HITS) & (F.col("sources") >= ledgers.MIN_SOURCES)).select("candidate", "hits", "sources")


@query(f"""WITH {SIGNALS}, k AS (SELECT source, unnest(list_distinct(string_split(lower(title), ' '))) AS candidate FROM signals)
SELECT candidate, count(*) AS hits FROM k WHERE length(candidate) > 3 GROUP BY candidate HAVING count(*) >= 3 AND count(DISTINCT source) = 1""")
def q36_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tallied(spark, sf_dir).filter((F.col("hits") >= ledgers.MIN_HITS) & (F.col("sources") == 1)).select("candidate", "hits")


def _tallied(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.array_distinct(F.split(F.lower("title"), " ")), lambda w: F.length(w) > 3)
    return ledgers.candidate_tally(signals(spark, sf_dir).select(F.col("doc_id").alias("ord"), "source", words.alias("candidates")))
