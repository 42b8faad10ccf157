"""How the driver's tables stand for the domain: the mapping is this repository's own and is stated here, once.

documents are signals: the first line is the title, what follows the summary; the number at the end of source gives its
tier, track, category and voice; times follow from doc_id. events are runs of sources and observations of items.
conversations are a ledger. orders, lineitem, supplier and part give events with evidence, boards and registries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its oracle if SQL can express it."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hours_after(start: str, hours: str) -> F.Column:
    return F.expr(f"timestampadd(HOUR, {hours}, TIMESTAMP '{start} 00:00:00')")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    docs = docs.withColumns({"n": number, "title": F.split_part("text", F.lit("\n"), F.lit(1))})
    docs = docs.withColumns(
        {
            "summary": F.substring("text", F.length("title") + 2, F.length("text")),
            "tier": F.when(F.col("n") % 4 > 0, F.col("n") % 4),
            "track": F.expr("element_at(array('official', 'official', 'media', 'kol', 'aggregator'), n % 5 + 1)"),
            "category": F.expr("element_at(array('vendor', 'research', 'industry'), n % 3 + 1)"),
            "voice": F.when(F.col("n") % 2 == 0, "social").otherwise("expert"),
            "url": F.concat(F.lit("https://example.org/d/"), "doc_id"),
            "author": F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("Author "), F.col("doc_id") % 50)),
            "published": F.when(F.col("doc_id") % 17 > 0, hours_after("2024-01-01", "cast(doc_id * 37 % 720 as int)")),
            "first_observed_at": hours_after("2024-01-02", "cast(doc_id * 53 % 960 as int)"),
            "n_tags": F.col("doc_id") % 5,
        }
    )
    return docs.withColumn("role", quality.effective_role(F.col("track"), F.col("category"), F.col("voice")))


SIGNALS = """
s0 AS (
  SELECT doc_id, text, lang, source, CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) AS n, split_part(text, chr(10), 1) AS title FROM documents
), signals AS (
  SELECT *, substr(text, length(title) + 2) AS summary, CASE WHEN n % 4 > 0 THEN n % 4 END AS tier,
    ['official', 'official', 'media', 'kol', 'aggregator'][n % 5 + 1] AS track, ['vendor', 'research', 'industry'][n % 3 + 1] AS category,
    CASE WHEN n % 2 = 0 THEN 'social' ELSE 'expert' END AS voice, 'https://example.org/d/' || doc_id AS url,
    CASE WHEN doc_id % 3 > 0 THEN 'Author ' || (doc_id % 50) END AS author,
    CASE WHEN doc_id % 17 > 0 THEN TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id * 37 % 720 AS INT)) END AS published,
    TIMESTAMP '2024-01-02' + to_hours(CAST(doc_id * 53 % 960 AS INT)) AS first_observed_at, doc_id % 5 AS n_tags,
    CASE WHEN n % 5 = 4 THEN 'aggregator' WHEN n % 5 = 2 THEN 'media' WHEN n % 5 = 3 THEN CASE WHEN n % 2 = 0 THEN 'social' ELSE 'expert' END
      WHEN n % 3 = 1 THEN 'research' ELSE 'primary' END AS role
  FROM s0
)"""

SCORED = SIGNALS + """, d0 AS (
  SELECT *, least(25, least(25, CAST(round_even(CASE tier WHEN 1 THEN 90 WHEN 2 THEN 65 WHEN 3 THEN 40 ELSE 50 END / 4.0, 0) AS INT))
      + CASE role WHEN 'primary' THEN 3 WHEN 'research' THEN 2 WHEN 'expert' THEN 1 ELSE 0 END) AS authority,
    least(25, CASE WHEN length(summary) > 800 THEN 10 WHEN length(summary) > 400 THEN 7 WHEN length(summary) > 100 THEN 4 ELSE 1 END
      + CASE WHEN length(title) > 20 AND length(title) < 150 THEN 8 WHEN length(title) > 10 THEN 4 ELSE 1 END
      + CASE WHEN n_tags >= 3 THEN 4 WHEN n_tags >= 1 THEN 2 ELSE 0 END) AS richness,
    (epoch_us(first_observed_at) - epoch_us(published)) / 3600000000.0 AS h,
    CASE WHEN role IN ('primary', 'research') THEN 15 WHEN role = 'expert' THEN 12 WHEN role = 'aggregator' THEN 4 ELSE 7 END AS originality,
    CASE WHEN length(url) > 10 THEN 3 ELSE 0 END + CASE WHEN length(title) > 5 THEN 3 ELSE 0 END + CASE WHEN length(summary) > 50 THEN 3 ELSE 0 END
      + CASE WHEN published IS NOT NULL THEN 3 ELSE 0 END + CASE WHEN category <> 'industry' THEN 1 ELSE 0 END + CASE WHEN n_tags > 0 THEN 1 ELSE 0 END
      + CASE WHEN author IS NOT NULL THEN 1 ELSE 0 END AS completeness
  FROM signals
), d1 AS (
  SELECT *, CASE WHEN h IS NULL THEN 10 WHEN h <= 1 THEN 20 WHEN h <= 6 THEN 18 WHEN h <= 24 THEN 15 WHEN h <= 72 THEN 10 WHEN h <= 168 THEN 6 WHEN h <= 720 THEN 3 ELSE 1 END AS freshness,
    CAST(floor(h / 24) AS INT) AS lead_days FROM d0
), d2 AS (
  SELECT *, authority + richness + freshness + originality + completeness AS total FROM d1
), scored AS (
  SELECT *, CASE WHEN total >= 85 THEN 'A' WHEN total >= 70 THEN 'B' WHEN total >= 55 THEN 'C' WHEN total >= 40 THEN 'D' ELSE 'F' END AS grade,
    list_filter([CASE WHEN authority < 8 THEN 'low-authority' END, CASE WHEN richness < 8 THEN 'thin-content' END, CASE WHEN freshness < 5 THEN 'stale' END,
      CASE WHEN role = 'aggregator' OR originality < 5 THEN 'aggregator-only' END, CASE WHEN published IS NULL THEN 'missing-date' END,
      CASE WHEN category = 'industry' THEN 'missing-category' END, CASE WHEN length(title) < 10 THEN 'short-title' END, CASE WHEN n_tags = 0 THEN 'no-tags' END],
      lambda x: x IS NOT NULL) AS flags FROM d2
)"""

#: Titles that name models, so that identity rules have something to find: one for each part, by its key.
TITLES = (
    "OpenAI GPT-4o mini available for part {k}", "Claude Opus 4.{v} released", "Gemini 2.5 Flash benchmark score {v}", "DeepSeek-V3 outage report {k}",
    "Qwen3 coder pricing update {v}", "Kimi K2 funding round {k}", "Plain maintenance note {k}", "Llama 3.{v} reasoning performance {k}",
)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, p_brand, title, at)"""
    options = F.array(*[F.lit(t) for t in TITLES])
    made = F.element_at(options, (F.col("p_partkey") % len(TITLES) + 1).cast("int"))
    made = F.replace(F.replace(made, F.lit("{k}"), F.concat(F.lit("k"), (F.col("p_partkey") % 40).cast("string"))), F.lit("{v}"), (F.col("p_partkey") % 7).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", made.alias("title"), hours_after("2024-01-01", "cast(p_partkey * 31 % 900 as int)").alias("at"))


TITLED = f"""
titled AS (
  SELECT p_partkey, p_brand, replace(replace([{", ".join(f"'{t}'" for t in TITLES)}][p_partkey % {len(TITLES)} + 1], '{{k}}', 'k' || (p_partkey % 40)), '{{v}}', CAST(p_partkey % 7 AS VARCHAR)) AS title,
    TIMESTAMP '2024-01-01' + to_hours(CAST(p_partkey * 31 % 900 AS INT)) AS seen FROM part
)"""
_STOP = "'a', 'an', 'and', 'for', 'in', 'of', 'on', 'the', 'to', 'update', 'with'"


def sql_tokens(title: str) -> str:
    """DuckDB expression of title_tokens()."""
    return f"list_distinct(list_filter(string_split(trim(regexp_replace(lower({title}), '[^a-z0-9一-鿿]+', ' ', 'g')), ' '), lambda w: length(w) > 1 AND w NOT IN ({_STOP})))"


def sql_fingerprint(title: str) -> str:
    """DuckDB expression of fingerprint()."""
    from tidemark.functions.text import FAMILIES

    cases = ""
    for family, pattern, groups in FAMILIES:
        parts = ", ".join(f"nullif(regexp_replace(regexp_extract(t, '{pattern}', {g}), '\\s+', '-', 'g'), '')" for g in range(1, groups + 1))
        cases += f" WHEN regexp_matches(t, '{pattern}') THEN concat_ws(':', '{family}', {parts})"
    return f"(SELECT CASE{cases} END FROM (SELECT regexp_replace(lower({title}), '[–—_]', '-', 'g') AS t))"


def sql_facet(title: str) -> str:
    """DuckDB expression of facet()."""
    from tidemark.functions.text import FACETS

    return "CASE" + "".join(f" WHEN regexp_matches(lower({title}), '{pattern}') THEN '{name}'" for name, pattern in FACETS) + " ELSE 'update' END"


SQL_JACCARD = "(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b})) * 1.0 / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) ELSE 0.0 END)"


def sql_jaccard(a: str, b: str) -> str:
    return SQL_JACCARD.format(a=a, b=b)
