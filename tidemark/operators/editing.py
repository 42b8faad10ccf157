"""Rules on texts that people or other programs hand in, and on what the dictionary doesn't know yet."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wording of one region and that of another, in the order in which they are replaced.
WORDING = (
    ("人工智能", "人工智慧"), ("服務器", "伺服器"), ("短視頻", "短影音"), ("視頻", "影片"), ("質量", "品質"), ("信息", "資訊"), ("網絡", "網路"), ("軟件", "軟體"), ("硬件", "硬體"),
    ("屏幕", "螢幕"), ("鼠標", "滑鼠"), ("打印", "列印"), ("默認", "預設"), ("兼容", "相容"), ("卸載", "移除"), ("反饋", "回饋"), ("水平", "水準"), ("立馬", "馬上"),
    ("性價比", "CP 值"), ("顏值", "外型"), ("靠譜", "可靠"), ("給力", "到位"), ("智能", "智慧"),
)
# Half-width marks and their full-width forms.
MARKS = ((",", "，"), (".", "。"), (":", "："), (";", "；"), ("!", "！"), ("?", "？"), ("(", "（"), (")", "）"))
HAN = "[一-鿿]"


def clean_wording(text: Column) -> Column:
    """Regional wording, ellipses, and full-width marks next to Han characters; numbers and addresses stay."""
    out = text
    for old, new in WORDING:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, r"\.{3,}", "⋯⋯")
    for mark, wide in MARKS:
        out = F.regexp_replace(out, rf"(?<={HAN})\{mark}|\{mark}(?={HAN})", wide)
    return out


def wording_changes(text: Column) -> Column:
    """The replaced words, so that no change goes unseen. Looked for one by one, as a longer word is gone before a shorter."""
    out, found = text, []
    for old, new in WORDING:
        found.append(F.when(out.contains(old), old))
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.array_compact(F.array(*found))


def translation(raw: Column, most: int, banned: tuple[str, ...], has_source: Column) -> Column:
    """struct(text, reject): the cleaned translation and the first reason to send it back, null if it passes."""
    text = F.regexp_replace(F.trim(F.regexp_replace(clean_wording(F.trim(F.coalesce(raw, F.lit("")))), r"\s+", " ")), "。+$", "")
    hit = F.filter(F.array(*[F.lit(w) for w in banned]), lambda w: F.contains(text, w)) if banned else F.array().cast("array<string>")
    reason = (
        F.when(text == "", "blank").when(~text.rlike(HAN), "untranslated").when(F.length(text) > most, "too_long").when(F.size(hit) > 0, F.concat(F.lit("banned:"), F.array_join(hit, ",")))
        .when(~has_source, "no_source")
    )
    return F.struct(text.alias("text"), reason.alias("reject"))


def strip_own_heading(text: Column, heading: str) -> Column:
    """A value without its own section heading in front, as a line or before a colon; at most three of them."""
    once = rf"^(?:#{{1,6}}[ \t]*{re.escape(heading)}[ \t]*[：:]?[ \t]*(?:\n+|$)|#{{1,6}}[ \t]*{re.escape(heading)}[ \t]*[：:][ \t]*)"
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+", "")
    for _ in range(3):
        out = F.regexp_replace(out, once, "")
    return out


def infer_company(hits: Column, names: dict[str, str], kinds: dict[str, str], owners: dict[str, str]) -> Column:
    """The first company among entity hits, else the first owner that is a company, else industry."""
    def lookup(table: dict[str, str]) -> Column:
        return F.create_map(*[F.lit(x) for kv in table.items() for x in kv]) if table else F.create_map().cast("map<string,string>")

    kind, name, owner = lookup(kinds), lookup(names), lookup(owners)
    direct = F.filter(F.coalesce(hits, F.array().cast("array<string>")), lambda h: F.try_element_at(kind, h) == "company")
    above = F.filter(F.transform(F.coalesce(hits, F.array().cast("array<string>")), lambda h: F.try_element_at(owner, h)), lambda o: F.try_element_at(kind, o) == "company")
    first = F.coalesce(F.get(direct, 0), F.get(above, 0))
    return F.coalesce(F.try_element_at(name, first), F.lit("industry"))


def heat_claims(text: Column, keyword: str, window: int = 12, negations: tuple[str, ...] = ("未量測", "量不到", "沒量到", "未接線")) -> Column:
    """Places where a text gives a number for something that nobody has measured."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?=((?:{keyword})[\s\S]{{0,{window}}}))(?:{keyword})"), 1)
    return F.filter(found, lambda w: F.regexp_replace(w, f"^(?:{keyword})", "").rlike("[0-9]") & ~w.rlike("|".join(negations)))


# Capitalised words that open sentences and headlines.
OPENERS = frozenset(
    ("The", "This", "That", "New", "AI", "How", "Why", "What", "We", "It", "In", "On", "For", "And", "But", "You", "Our", "A", "An", "Introducing", "Announcing", "Launching",
     "Presenting", "Meet", "Today", "Now", "Update", "Release", "Blog", "Read", "More")
)
# What a name may look like: up to three capitalised words, or a phrase in brackets.
NAMES = r"\b(?:[A-Z][a-zA-Z0-9]*(?:[-.][A-Za-z0-9]+)*(?:\s[A-Z][a-zA-Z0-9]*){0,2})\b"
BRACKETED = "[「『《【\"“]([^」』》】\"”]{2,20})[」』》】\"”]"


def candidates(text: Column, keys: Column, surfaces: Column) -> Column:
    """Names in a text that none of its matched surfaces holds or is part of, each once: capitalised ones, then bracketed.

    keys: the folded forms of names_in(text), in its order. surfaces: folded surfaces that the dictionary has matched.
    """
    both = F.arrays_zip(names_in(text).alias("name"), keys.alias("key"))
    known = F.coalesce(surfaces, F.array().cast("array<string>"))
    new = F.filter(both, lambda x: (x["key"] != "") & ~F.exists(known, lambda s: F.contains(s, x["key"]) | F.contains(x["key"], s)))
    own = F.transform(new, lambda x: x["key"])
    return F.transform(F.filter(new, lambda x, i: F.array_position(own, x["key"]) == i + 1), lambda x: x["name"])


def names_in(text: Column) -> Column:
    """All that may be names, of three characters at least, but for words that open sentences."""
    t = F.coalesce(text, F.lit(""))
    every = F.concat(F.regexp_extract_all(t, F.lit(NAMES), 0), F.regexp_extract_all(t, F.lit(BRACKETED), 1))
    trimmed = F.transform(every, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.filter(trimmed, lambda x: (F.length(x) >= 3) & ~x.isin(*sorted(OPENERS)))


def harvest(df: DataFrame, column: str, dictionary: list[tuple[str, str, str]]) -> DataFrame:
    """df with candidates; dictionary: (id, surface, type). Only surfaces that it has matched in the text rule out a name."""
    from tidemark.operators.entities import match_entities

    matched = match_entities(df, column, dictionary)
    # one call folds all names of a text; white space inside a name becomes one space, so lines keep them apart
    lines = F.array_join(F.transform(names_in(F.col(column)), lambda x: F.regexp_replace(x, r"(?U)\s+", " ")), "\n")
    keys = F.transform(F.split("_lines", "\n"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    named = matched.withColumn("_lines", folded_lines(lines)).withColumn("_keys", F.when(F.size(names_in(F.col(column))) > 0, keys).otherwise(F.array().cast("array<string>")))
    return named.withColumn("candidates", candidates(F.col(column), F.col("_keys"), F.col("entity_surfaces"))).drop("_lines", "_keys", *[c for c in ("entity_hits", "entity_types", "entity_surfaces") if c not in df.columns])


def folded_lines(text: Column) -> Column:
    from tidemark.functions.text import fold
    from tidemark.operators.entities import UNSEEN

    return F.translate(fold(text), UNSEEN, "")


def _quoted(word: str) -> str:
    """A word as a pattern that Java and Python read alike."""
    return "".join(c if c.isalnum() or c == " " else f"\\{c}" for c in word)


def _versions(text: Column, line: str, surface: str, pattern: str) -> Column:
    """line@version for each place where the surface and the pattern stand, outside of longer words and versions."""
    rule = F.lit(rf"(?i)(?<![A-Za-z0-9]){_quoted(surface)}(?:{pattern})(?![-.]\d)")
    places = F.regexp_extract_all(text, rule, 0)
    groups = [F.regexp_extract_all(text, rule, n) for n in range(1, re.compile(pattern).groups + 1)]
    named = F.transform(places, lambda _, n: F.lower(F.array_join(F.filter(F.array(*[F.get(g, n) for g in groups]), lambda x: x != ""), " ")))
    versions = F.transform(named, lambda v: F.regexp_replace(F.trim(F.regexp_replace(v, r"\s+", "-"), F.lit("-")), r"^v(?=[0-9])", ""))
    return F.transform(F.filter(versions, lambda v: v.rlike("[0-9]")), lambda v: F.concat(F.lit(f"{line}@"), v))


def derive_versions(df: DataFrame, column: str, lines: list[tuple[str, list[str], str]]) -> DataFrame:
    """df with derived_entities, like line@version; lines: (id, surfaces, version pattern with groups).

    Lines come in their order, each version once; a null text, or lines without a pattern, have none.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    made = [_versions(text, i, s, pattern) for i, surfaces, pattern in lines if pattern and re.compile(pattern).groups for s in surfaces if s]
    return df.withColumn("derived_entities", F.array_distinct(F.concat(*made)) if made else F.array().cast("array<string>"))


def chain_alert(day: Column, today: Column, stale_days: int, measurable: Column) -> Column:
    """struct(code, alert) of a chain's last day: unmeasurable, never, future, stale or ok. A future day isn't freshness."""
    lag = F.datediff(today, day)
    code = (
        F.when(~measurable | today.isNull(), "unmeasurable").when(day.isNull(), "never").when(lag < 0, "future").when(lag >= stale_days, "stale").otherwise("ok")
    )
    return F.struct(code.alias("code"), code.isin("never", "future", "stale").alias("alert"))


def robots_change(before: Column, reason: Column, checked_days: Column, stale_days: int) -> Column:
    """What a recheck of a site's rules comes to: an answer that can't be had changes nothing."""
    return (
        F.when(checked_days < stale_days, "skip").when(reason.isin("unreachable", "error", "not_robots", "unavailable_403"), "unknown_keep")
        .when(reason.isin("ok", "no_robots"), F.when(F.coalesce(before, F.lit(False)), "unchanged").otherwise("opened"))
        .otherwise(F.when(F.coalesce(~before, F.lit(False)), "unchanged").otherwise("closed"))
    )


def sticky_last(rows: DataFrame, key: str, day: str, hit: Column) -> DataFrame:
    """rows with the last day up to each row on which something was there; null as long as it never was."""
    from pyspark.sql import Window as W

    upto = W.partitionBy(key).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("last_day", F.max(F.when(hit, F.col(day))).over(upto))


def cron_entries(df: DataFrame, column: str) -> DataFrame:
    """One row a cron line of a workflow: expr, comment, and the hour if it runs once a day."""
    lines = F.regexp_extract_all(F.col(column), F.lit(r"(?m)^\s*-\s*cron:\s*(['\"][^'\"]+['\"]\s*(?:#.*)?)$"), 1)
    each = df.withColumn("line", F.explode(lines))
    expr, comment = F.trim(F.regexp_extract("line", r"^['\"]([^'\"]+)", 1)), F.trim(F.regexp_extract("line", "(#.*)$", 1))
    hour = F.nullif(F.regexp_extract(expr, r"^\d+ (\d+) \* \* \*$", 1), F.lit("")).cast("int")
    return each.select(*df.columns, expr.alias("expr"), comment.alias("comment"), hour.alias("daily_hour")).drop(column)
