"""Signal quality: five dimensions, total, grade, flags; and whether a signal may open an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, text

# Grades from these totals on; below the last one a signal is discarded.
GRADES = (("A", 85), ("B", 70), ("C", 55), ("D", 40))
DISCARD_BELOW = 40
#: Older than this when first seen: historical archive.
MAX_LEAD_DAYS = 7
OPENS_EVENT = 70


def effective_role(track: Column, category: Column, role: Column) -> Column:
    """What a source counts as: its section's track first; a voice's own role and a publisher's category within it."""
    return (
        F.when(track.isin("aggregator", "media"), track).when(track == "kol", F.when(role == "social", "social").otherwise("expert"))
        .when(category == "research", "research").otherwise("primary")
    )


def tier_authority(tier: Column) -> Column:
    t = tier.try_cast("int")
    return F.when(t == 1, 90).when(t == 2, 65).when(t == 3, 40).otherwise(50)


def authority(role: Column, base: Column) -> Column:
    bonus = F.when(role == "primary", 3).when(role == "research", 2).when(role == "expert", 1).otherwise(0)
    part = F.least(F.lit(25), F.bround(F.coalesce(base, F.lit(50)) / 4).cast("int"))
    return F.least(F.lit(25), part + bonus)


def richness(title: Column, summary: Column, n_tags: Column) -> Column:
    s, t = F.length(F.coalesce(summary, F.lit(""))), F.length(F.coalesce(title, F.lit("")))
    by_summary = F.when(s > 800, 10).when(s > 400, 7).when(s > 100, 4).otherwise(1)
    by_title = F.when((t > 20) & (t < 150), 8).when(t > 10, 4).otherwise(1)
    return F.least(F.lit(25), by_summary + by_title + F.when(n_tags >= 3, 4).when(n_tags >= 1, 2).otherwise(0))


def freshness(published: Column, seen: Column) -> Column:
    h = dates.micros_between(seen, published) / 3_600_000_000
    return F.when(h.isNull(), 10).when(h <= 1, 20).when(h <= 6, 18).when(h <= 24, 15).when(h <= 72, 10).when(h <= 168, 6).when(h <= 720, 3).otherwise(1)


def originality(role: Column, has_origin: Column | None = None) -> Column:
    origin = has_origin if has_origin is not None else F.lit(False)
    return F.when(role.isin("primary", "research"), 15).when(role == "expert", 12).when(origin, 10).when(role.isin("aggregator", "heat"), 4).otherwise(7)


def completeness(url: Column, title: Column, summary: Column, published: Column, category: Column, n_tags: Column, author: Column) -> Column:
    def has(condition: Column, points: int) -> Column:
        return F.when(condition, points).otherwise(0)

    return (
        has(F.length(url) > 10, 3) + has(F.length(title) > 5, 3) + has(F.length(summary) > 50, 3) + has(published.isNotNull(), 3)
        + has((category != "") & (category != "industry"), 1) + has(n_tags > 0, 1) + has(author != "", 1)
    )


def grade(total: Column) -> Column:
    out = F.lit("F")
    for name, least in reversed(GRADES):
        out = F.when(total >= least, name).otherwise(out)
    return out


def flags(role: Column, published: Column, category: Column, title: Column, n_tags: Column) -> Column:
    """Codes in a fixed order; reads the dimension columns."""
    blank = F.coalesce(category, F.lit("")).isin("", "industry")
    rules = (
        ("low-authority", F.col("authority") < 8), ("thin-content", F.col("richness") < 8), ("stale", F.col("freshness") < 5),
        ("aggregator-only", (role == "aggregator") | (F.col("originality") < 5)), ("missing-date", published.isNull()), ("missing-category", blank),
        ("short-title", F.length(F.coalesce(title, F.lit(""))) < 10), ("no-tags", F.coalesce(n_tags, F.lit(0)) == 0),
    )
    return F.array_compact(F.array(*[F.when(rule, code) for code, rule in rules]))


def score(signals: DataFrame) -> DataFrame:
    """signals (title, summary, url, author, published, first_observed_at, category, n_tags, role, tier) with the five
    dimensions, total, grade, flags and lead_days. The reference time of freshness is when the signal was first seen."""
    c = F.col
    dims = signals.withColumns(
        {
            "authority": authority(c("role"), tier_authority(c("tier"))), "richness": richness(c("title"), c("summary"), c("n_tags")),
            "freshness": freshness(c("published"), c("first_observed_at")), "originality": originality(c("role")),
            "completeness": completeness(c("url"), c("title"), c("summary"), c("published"), c("category"), c("n_tags"), c("author")),
            "lead_days": dates.floor_days(c("first_observed_at"), c("published")),
        }
    )
    total = c("authority") + c("richness") + c("freshness") + c("originality") + c("completeness")
    return dims.withColumn("total", total).withColumns({"grade": grade(c("total")), "flags": flags(c("role"), c("published"), c("category"), c("title"), c("n_tags"))})


def recent(lead_days: Column, most: int = MAX_LEAD_DAYS) -> Column:
    """Not archive; an unknown lead passes, and 0 switches the rule off."""
    return F.lit(True) if not most else F.coalesce(lead_days <= most, F.lit(True))


# Wording by which a title announces something, and a summary contributes research that decisions rest on.
ANNOUNCES = (
    r"(?i)releas(?:e|ed|es|ing)|launch(?:es|ed|ing)?|announc(?:e|ed|es|ing)|introduc(?:e|ed|es|ing)|\bavailable\b|availability|general(?:ly)? available"
    r"|preview(?:ing|ed)?|\badds?\b|now supports?|support for|open[- ]source|funding|acqui(?:re|red|sition)|regulation|policy"
    r"|发布|推出|上线|可用|预览|新增|支持|开源|融资|并购|收购|监管|政策"
)
CONTRIBUTES = r"(?i)benchmark|dataset|framework|method|mechanism|architecture|evaluation|empirical|study|analysis|taxonomy|基准|数据集|框架|方法|机制|架构|评测|实证|研究"
DECIDES = (
    r"(?i)large language model|\bLLMs?\b|agent|reasoning|long[- ]context|coding|code model|multimodal|vision[- ]language|training|inference|alignment|robot|memory"
    r"|context compression|tool use|causal|智能体|推理|长上下文|编码|多模态|训练|对齐|机器人|记忆|上下文压缩|工具使用|因果"
)
SUBSTANTIVE = ("vendor", "research", "framework", "regulator")


def decision_research(title: Column, summary: Column) -> Column:
    t, s = F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit(""))
    content = F.concat(t, F.lit(" "), s)
    return (F.length(F.trim(s)) >= 160) & content.rlike(CONTRIBUTES) & content.rlike(DECIDES)


def eventability(title: Column, summary: Column, role: Column, category: Column, tier: Column, quality: Column) -> Column:
    """0 to 100; from OPENS_EVENT on a signal may open an event. A null category and role: no source, 0."""
    def has(condition: Column, points: int) -> Column:
        return F.when(condition, points).otherwise(0)

    decides = (role == "research") & decision_research(title, summary)
    t = F.coalesce(title, F.lit(""))
    level = tier.try_cast("int")
    points = (
        F.when(level == 1, 25).when(level == 2, 10).otherwise(0) + F.when(role.isin("primary", "policy"), 20).when(role == "research", 10).otherwise(0)
        + has(category.isin(*SUBSTANTIVE), 15) + has(decides, 25) + has(t.rlike(ANNOUNCES), 20) + has(text.fingerprint(F.lower(t)).isNotNull(), 20) + has(quality >= 70, 10)
    )
    capped = F.least(points, F.when((role == "research") & ~decides, 65).otherwise(100))
    return F.when((role == "aggregator") | (category == "aggregator") | (role.isNull() & category.isNull()), 0).otherwise(capped)
