"""Registries of sources, tracks and entities: their rows, and what a row of data takes from them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sections of the entity dictionary, and what ends the identifier of a template.
ENTITY_SECTIONS = ("companies", "product_lines", "infrastructure", "frameworks", "technologies", "policies")
TEMPLATE = "<slug>"
# Tracks by slug, in the order in which they are shown, with their names and another spelling of one.
TRACKS = (
    ("model-research", "模型能力與研究"), ("agent-refactor", "Agent 與軟體重構"), ("product-market", "產品與商業驗證"),
    ("infra-cost", "基礎設施與成本"), ("capital-evolution", "資本與公司演化"), ("global-map", "全球創新版圖"),
)
SPELLINGS = (("Agent與軟體重構", "Agent 與軟體重構"),)

SOURCE_SCHEMA = "ord int, section string, id string, track string, source_category string, role string, tier int, lifecycle string, language string, region string, media_group string, person_id string"
_FIELDS = ("track", "source_category", "role", "tier", "lifecycle", "language", "region", "media_group", "person_id")


def source_rows(raw: dict, sections: Iterable[str], skip_templates: bool = True) -> Iterator[tuple]:
    """Rows of SOURCE_SCHEMA from a registry's sections, in their order; entries without an identifier are none."""
    n = 0
    for section in sections:
        for entry in raw.get(section) or []:
            name = str(entry.get("id") or "")
            if name and not (skip_templates and name.endswith(TEMPLATE)):
                tier = str(entry.get("tier") if entry.get("tier") is not None else "")
                yield (n, section, name, *[(int(tier) if tier.isdigit() else None) if f == "tier" else entry.get(f) for f in _FIELDS])
                n += 1


def sources(spark: SparkSession, raw: dict, sections: Iterable[str], skip_templates: bool = True) -> DataFrame:
    """The registry as a table, one row an identifier; of several entries with one the last counts."""
    last = {row[2]: row for row in source_rows(raw, sections, skip_templates)}
    return spark.createDataFrame(sorted(last.values()), SOURCE_SCHEMA)


def dictionary(raw: dict) -> list[tuple[str, str, str]]:
    """(identifier, surface, type) for each name and alias of a dictionary, in its order."""
    items = [item for section in ENTITY_SECTIONS for item in raw.get(section) or []]
    return [(item["id"], str(term), item["term_type"]) for item in items for term in (item["canonical"], *(item.get("aliases") or ()))]


def with_sources(signals: DataFrame, registry: DataFrame) -> DataFrame:
    """signals (source_id, track, tier) with what the registry says of their source, and state: known, missing or dormant.

    A missing source keeps the row's own track and tier, and has neither role nor category. Dormant ones are marked, so
    that leaving them out can be counted. The registry is broadcast: it is written by hand.
    """
    cols = ("track", "tier", "role", "source_category", "lifecycle")
    known = F.broadcast(registry.select(F.col("id").alias("source_id"), *[F.col(c).alias(f"_{c}") for c in cols], F.lit(True).alias("_known")))
    state = F.when(F.col("_known").isNull(), "missing").when(F.col("_lifecycle") == "dormant", "dormant").otherwise("known")
    both = signals.join(known, "source_id", "left").withColumn("state", state)
    own = {c: F.when(F.col("_known"), F.col(f"_{c}")).otherwise(F.col(c)) for c in ("track", "tier")}
    return both.withColumns(own | {"role": F.col("_role"), "source_category": F.col("_source_category")}).drop("_known", *[f"_{c}" for c in cols])


def evidence_tiers(evidence: DataFrame, registry: DataFrame) -> DataFrame:
    """evidence (source_id) with tier, 3 where the registry has none, and primary: of the first tier and no aggregator."""
    known = F.broadcast(registry.select(F.col("id").alias("source_id"), F.col("tier").alias("_tier"), F.col("role").alias("_role"), F.col("source_category").alias("_category")))
    tier = F.coalesce(F.col("_tier").cast("string").try_cast("int"), F.lit(3))
    relays = F.coalesce(F.col("_role") == "aggregator", F.lit(False)) | F.coalesce(F.col("_category") == "aggregator", F.lit(False))
    return evidence.join(known, "source_id", "left").withColumns({"tier": tier, "primary": (tier == 1) & ~relays}).drop("_tier", "_role", "_category")


def look_up(value: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """What a trimmed value stands for, exactly; null if it isn't among pairs."""
    flat = [F.lit(x) for pair in pairs for x in pair]
    return F.try_element_at(F.create_map(*flat), F.trim(F.coalesce(value, F.lit(""))))


def track_name(track: Column) -> Column:
    return look_up(track, (*((name, name) for _, name in TRACKS), *SPELLINGS))


def track_slug(track: Column) -> Column:
    return look_up(track_name(track), ((name, slug) for slug, name in TRACKS))


def signal_kind(source_id: Column, role: Column, category: Column, track: Column) -> Column:
    """aggregator, research, official or media, of a signal and its source."""
    kind, part, name = (F.lower(F.coalesce(c, F.lit(""))) for c in (category, role, source_id))
    way = F.coalesce(track, F.lit(""))
    return (
        F.when((kind == "aggregator") | (way == "aggregator"), "aggregator").when((kind == "research") | part.contains("research") | name.contains("arxiv"), "research")
        .when(kind.isin("vendor", "official", "policy") | (way == "official"), "official").otherwise("media")
    )


def development(category: Column, tier: Column, track: Column, first: Column) -> Column:
    """origin, official, discussion or response, of an item in an event's course."""
    kind = F.lower(F.coalesce(category, F.lit("")))
    return (
        F.when(first, "origin").when(kind.isin("vendor", "research") | F.coalesce(tier == 1, F.lit(False)), "official")
        .when((kind == "aggregator") | (F.coalesce(track, F.lit("")) == "aggregator"), "discussion").otherwise("response")
    )


# Words of source names that are written in their own way.
SPELT = (
    ("deepmind", "DeepMind"), ("openai", "OpenAI"), ("arxiv", "arXiv"), ("hn", "Hacker News"), ("ai", "AI"), ("eu", "EU"), ("itre", "ITRE"), ("kol", "KOL"),
    ("blog", "Blog"), ("rss", "RSS"), ("nvidia", "NVIDIA"), ("the", "The"), ("decoder", "Decoder"), ("infoq", "InfoQ"),
)


def source_name(source_id: Column) -> Column:
    """An identifier as it is shown to readers."""
    words = F.array_remove(F.split(F.regexp_replace(F.regexp_replace(F.coalesce(source_id, F.lit("")), "^src-", ""), "[-_]", " "), r"\s+"), "")
    spelt = F.create_map(*[F.lit(x) for pair in SPELT for x in pair])
    shown = F.transform(words, lambda w: F.coalesce(F.try_element_at(spelt, F.lower(w)), F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))))
    return F.when(F.size(words) == 0, "來源").otherwise(F.array_join(shown, " "))


def file_name(name: Column) -> Column:
    """A name without what file systems refuse, and otherwise as it is."""
    return F.coalesce(F.nullif(F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), r'[\\/:*?"<>|]', "-"), F.lit("")), F.lit("unnamed"))


def escaped(text: Column) -> Column:
    """Text with the five characters that mean something in markup as references."""
    out = F.coalesce(text, F.lit(""))
    for mark, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(mark), F.lit(reference))
    return out


def is_day(name: Column) -> Column:
    """Whether a partition's name is a day that exists, written YYYY-MM-DD."""
    return F.coalesce(name.rlike(r"^\d{4}-\d{2}-\d{2}$") & name.try_cast("date").isNotNull(), F.lit(False))


def filled_days(lines: DataFrame) -> DataFrame:
    """Days, in order, of lines (day, line) that have one line that isn't blank at least."""
    return lines.filter(is_day(F.col("day"))).groupBy("day").agg(F.bool_or(F.trim("line") != "").alias("filled")).filter("filled").select("day").orderBy("day")


# Wording that stands where an editor's text is still to come.
PLACEHOLDERS = ("待編輯", "待编辑", "待補充", "待补充", "TBD", "TODO", "placeholder")


def has_placeholder(body: Column) -> Column:
    return F.coalesce(body, F.lit("")).rlike("(?i)" + "|".join(PLACEHOLDERS))
