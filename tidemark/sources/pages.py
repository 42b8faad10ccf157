"""Web pages and feeds, from bytes already fetched: article metadata, release notes, RSS, Atom, sitemaps, JSON APIs."""

from __future__ import annotations

import html as _html
import json
import re
from urllib.parse import urlsplit
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, text

ITEM = "array<struct<title:string,summary:string,url:string,published:string,author:string>>"
SUMMARY_CHARS = 300


def article_metadata(pages: DataFrame) -> DataFrame:
    """pages (html) with title, og_title, description, published, lang and the number of links; what is absent is null."""
    h = F.coalesce("html", F.lit(""))

    def found(pattern: str) -> Column:
        return F.nullif(F.trim(F.regexp_extract(h, pattern, 1)), F.lit(""))

    def meta(name: str) -> Column:
        return F.coalesce(found(rf'(?is)<meta[^>]*(?:property|name)="{name}"[^>]*content="([^"]*)"'), found(rf'(?is)<meta[^>]*content="([^"]*)"[^>]*(?:property|name)="{name}"'))

    return pages.withColumns(
        {
            "title": found(r"(?is)<title[^>]*>(.*?)</title>"), "og_title": meta("og:title"), "description": meta("og:description"),
            "published": F.coalesce(meta("article:published_time"), found(r'(?is)"datePublished"\s*:\s*"([^"]+)"'), found(r'(?is)<time[^>]*datetime="([^"]+)"')),
            "lang": found(r'(?s)<html[^>]*\blang="([^"]+)"'), "links": F.size(F.regexp_extract_all(h, F.lit(r'<a\s[^>]*href="([^"]+)"'), 1)).cast("long"),
        }
    )


def excerpt_allowed(source_host: Column, item_url: Column, allowed: Column) -> Column:
    """Only where the source permits it, and only from its own host; the port counts."""
    return F.coalesce(allowed, F.lit(False)) & F.coalesce(F.lower(F.regexp_extract(item_url, r"^[^:/?#]+://([^/?#]*)", 1)) == F.lower(source_host), F.lit(False))


def _clean(markup: str | None) -> str:
    return " ".join(_html.unescape(re.sub(r"<[^>]*>", " ", markup or "")).split())


def _local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def _children(e: ET.Element) -> dict[str, list[ET.Element]]:
    out: dict[str, list[ET.Element]] = {}
    for c in e:
        out.setdefault(_local(c), []).append(c)
    return out


def read_feed(body: str | None, quota: int) -> list[dict]:
    """Items of an RSS or Atom feed in feed order; a link falls back to the identifier; text without markup."""
    try:
        root = ET.fromstring(body or "")
    except ET.ParseError:
        return []
    out = []
    for item in (e for e in root.iter() if _local(e) in ("item", "entry")):
        c = _children(item)

        def first(*names: str, c: dict = c) -> str | None:
            return next((x.text.strip() for n in names for x in c.get(n, []) if x.text and x.text.strip()), None)

        links = [x.get("href") for x in c.get("link", []) if x.get("href") and x.get("rel", "alternate") == "alternate"]
        url = first("link") or (links[0] if links else None) or first("guid", "id")
        names = [y.text for x in c.get("author", []) for y in x if _local(y) == "name" and y.text]
        author = first("creator") or (names[0] if names else None) or first("author")
        summary = _clean(first("description", "summary", "content", "encoded"))[:SUMMARY_CHARS]
        out.append({"title": _clean(first("title")), "summary": summary, "url": url, "published": first("pubDate", "published", "updated", "date"), "author": author})
        if len(out) >= quota:
            break
    return out


#: A word with a letter, and two short numbers after it, which are one version.
VERSIONED = re.compile(r"(?<![^-])([^-]*[^\W\d_][^-]*)-(\d{1,2})-(\d{1,2})(?![^-])")


def slug_title(url: str) -> str:
    """A title from the last part of an address: two short numbers after a word with a letter are a version."""
    path = urlsplit(url).path.rstrip("/")
    dashed = re.sub("[-_]+", "-", re.sub(r"\.(?:html?|php|aspx?)$", "", path[path.rfind("/") + 1 :])).strip("-")
    as_written = lambda w: w.isupper() or any(c.isdigit() for c in w)
    return " ".join(w if as_written(w) else w.capitalize() for w in VERSIONED.sub(r"\1-\2.\3", dashed).split("-"))


def read_sitemap(body: str | None, quota: int, prefix: str = "", hints: tuple[str, ...] = ()) -> list[dict]:
    """Pages of a sitemap below a prefix, newest first; the index of a sitemap gives its parts that a hint names."""
    try:
        root = ET.fromstring(body or "")
    except ET.ParseError:
        return []
    rows = []
    for e in root:
        c = _children(e)
        loc = next((x.text.strip() for x in c.get("loc", []) if x.text), None)
        if loc is None or (_local(e) == "sitemap" and hints and not any(h in loc for h in hints)) or not loc.startswith(prefix):
            continue
        rows.append((next((x.text.strip() for x in c.get("lastmod", []) if x.text), ""), loc))
    rows.sort(key=lambda r: r[0], reverse=True)
    return [{"title": slug_title(loc), "summary": "", "url": loc, "published": mod or None, "author": None} for mod, loc in rows[:quota]]


def _walk(value: object, path: str) -> object:
    for part in filter(None, path.split(".")):
        value = value.get(part) if isinstance(value, dict) else None
    return value


def read_json_api(body: str | None, quota: int, root: str, fields: dict[str, str], url_fallback: str = "") -> list[dict]:
    """Items below a dotted path, their fields by dotted paths; numbers as times are seconds since 1970."""
    try:
        items = _walk(json.loads(body or ""), root)
    except ValueError:
        return []
    out = []
    for item in (items if isinstance(items, list) else [])[:quota]:
        row = {k: _walk(item, fields[k]) if k in fields else None for k in ("title", "summary", "url", "published", "author")}
        if isinstance(row["published"], (int, float)):
            row["published"] = pd.Timestamp(row["published"], unit="s", tz="UTC").isoformat()
        row = {k: None if v is None else str(v) for k, v in row.items()}
        row["url"] = row["url"] or (url_fallback.format(**{k: item.get(k, "") for k in re.findall(r"{(\w+)}", url_fallback)}) if url_fallback and isinstance(item, dict) else None)
        row["summary"] = _clean(row["summary"])[:SUMMARY_CHARS]
        out.append(row)
    return out


#: Releases of a repository are one shape of JSON API.
RELEASES = {"title": "name", "summary": "body", "url": "html_url", "published": "published_at", "author": "author.login"}


def items_of(bodies: DataFrame, reader: Callable[[str | None], list[dict]]) -> DataFrame:
    """bodies (source_id, body, quota, …) as one row an item, with pos in feed order; a body that can't be read has none."""

    @F.pandas_udf(ITEM)
    def read(body: pd.Series) -> pd.Series:
        return body.map(reader)

    kept = [c for c in bodies.columns if c != "body"]
    return bodies.select(*kept, F.posexplode(read("body")).alias("pos", "item")).select(*kept, "pos", "item.*")


# a month in full or short, then day and year
ANCHOR = rf'(?i)id="((?:{"|".join(m[:3] for m in dates.MONTHS)})[a-z]*-\d{{1,2}}(?:st|nd|rd|th)?-20\d{{2}})"'
#: Parts of a page that hold no entries.
BESIDE = r"(?is)<(nav|footer|aside)\b.*?</\1>"


def release_notes(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) as rows of a release page: anchor, pos, text, date, lifecycle, model_ids, tail.

    The page is cut at dated anchors; each list item is a row, and text beside lists if it has 40 characters. Menus,
    footers and asides aren't read, and a text that is a date alone is no entry. The last part is marked, as a page's
    end may hold anything. A page without such anchors, or a null one, has no rows.
    """
    parts = F.filter(F.split(F.regexp_replace("html", ANCHOR, "\u0001$1\u0002"), "\u0001"), lambda p: p.contains("\u0002"))
    cut = pages.select("page_id", F.posexplode(parts).alias("part", "chunk"), F.size(parts).alias("n"))
    chunk = cut.select("page_id", "part", (F.col("part") == F.col("n") - 1).alias("tail"), F.split_part("chunk", F.lit("\u0002"), F.lit(1)).alias("anchor"), F.regexp_replace(F.split_part("chunk", F.lit("\u0002"), F.lit(2)), r"^[^>]*>", "").alias("body"))
    chunk = chunk.withColumn("body", F.regexp_replace("body", BESIDE, " "))
    items = F.regexp_extract_all("body", F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), 1)
    rest = F.regexp_replace("body", r"(?is)<li\b[^>]*>.*?</li>", " ")
    rows = F.concat(F.filter(text.strip_all(items), lambda t: t != ""), F.filter(F.array(text.strip_tags(rest)), lambda t: F.length(t) >= 40))
    flat = chunk.select("page_id", "part", "tail", "anchor", F.posexplode(rows).alias("pos", "text")).filter(~dates.is_date_only(F.col("text")))
    date = dates.entry_date(F.replace("anchor", F.lit("-"), F.lit(" ")))
    return flat.select("page_id", "part", "pos", "tail", "anchor", "text", date["iso"].alias("date"), text.lifecycle(F.col("text")).alias("lifecycle"), text.model_ids(F.col("text")).alias("model_ids"))


def robots_reason(status: Column, kind: Column, allowed: Column) -> Column:
    """ok, disallow, no_robots, unavailable_403, unreachable, not_robots or error, from a fetch that was made elsewhere."""
    return (
        F.when(status.isNull(), "unreachable").when(status.isin(404, 410), "no_robots").when(status == 403, "unavailable_403").when(status != 200, "error")
        .when(kind != "robots", "not_robots").when(allowed, "ok").otherwise("disallow")
    )


def zero_yield(diag: Column) -> Column:
    """Why a fetch gave no item, from its diagnosis (struct of counts)."""
    return (
        F.when(diag.isNull(), "no_diagnosis").when(diag["bytes"] == 0, "upstream_empty_body").when((diag["hints"] > 0) & (diag["hint_matches"] == 0), "hints_matched_nothing")
        .when(diag["parts_failed"] > 0, "sub_sitemap_unreachable").when((diag["seen"] > 0) & (diag["after_prefix"] == 0), "prefix_filtered_all").when(diag["seen"] == 0, "source_empty").otherwise("unknown")
    )



COVERAGE = "array<struct<dialect:string,error:string,items:int,title:int,link:int,date:int,guid:int,author:int>>"
# Names of a feed's fields in either dialect.
_FIELDS = {"rss": {"title": ("title",), "link": ("link",), "date": ("pubDate",), "guid": ("guid",)}, "atom": {"title": ("title",), "link": ("link",), "date": ("updated",), "guid": ("id",)}}


def feed_coverage(body: str | None) -> dict:
    """How many items of a feed have each field, as text of its own; error: unreadable, or another root than a feed has."""
    try:
        root = ET.fromstring(body or "")
    except ET.ParseError:
        return {"error": "unreadable"}
    dialect = {"rss": "rss", "feed": "atom"}.get(_local(root))
    if dialect is None:
        return {"error": f"root {_local(root)}"}
    holders = _children(root).get("channel", [])[:1] if dialect == "rss" else [root]
    told = [_children(e) for holder in holders for e in _children(holder).get("item" if dialect == "rss" else "entry", [])]

    def filled(elements: Iterable[ET.Element]) -> bool:
        return any(x.text and x.text.strip() for x in elements)

    def author(c: dict) -> list[ET.Element]:
        return [*c.get("author", []), *c.get("creator", [])] if dialect == "rss" else [y for x in c.get("author", []) for y in x if _local(y) == "name"]

    counts = {key: sum(filled(x for n in names for x in c.get(n, [])[:1]) for c in told) for key, names in _FIELDS[dialect].items()}
    return {"dialect": dialect, "items": len(told), "author": sum(filled(author(c)) for c in told)} | counts


def inspect_feeds(bodies: DataFrame) -> DataFrame:
    """bodies (source_id, body, …) with feed_coverage() of each, and whether links must fall back to identifiers.

    A body that is null, empty or no XML has error unreadable and null counts. Rows that repeat stay; other columns stay.
    """

    @F.pandas_udf(COVERAGE)
    def read(body: pd.Series) -> pd.Series:
        return body.map(lambda b: [feed_coverage(b)])

    told = bodies.withColumn("_told", F.get(read("body"), 0)).drop("body")
    return told.select(*[c for c in told.columns if c != "_told"], "_told.*").withColumn("link_fallback_needed", (F.col("link") < F.col("items")) & (F.col("guid") > F.col("link")))
