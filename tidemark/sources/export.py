"""Events as notes: fields in a fixed order, evidence by a whitelist, one field changed without touching the rest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of a note in the order in which they are written, and those of a piece of evidence.
FIELDS = (
    "id", "slug", "title", "title_zh", "title_zh_src", "date", "happened_at", "ingested_at", "recovered_by", "coverage", "status", "category", "company", "track", "fingerprint",
    "facet", "tier_evidence", "independent_sources", "suspected_reposts", "primary_evidence", "confidence", "heat", "impact", "value", "score_factors", "blockers", "warnings",
    "keywords", "next_signal", "evidence", "tags",
)
EVIDENCE = ("source_id", "url", "title", "relevance", "published", "suspected_repost")


def evidence_fields(evidence: Column, has: tuple[str, ...]) -> Column:
    """Evidence with the fields that a note may hold."""
    return F.transform(evidence, lambda e: F.struct(*[e[c].alias(c) for c in EVIDENCE if c in has]))


def notes(events: DataFrame, sections: tuple[str, ...]) -> DataFrame:
    """(id, note): front matter as JSON values a line (a subset of YAML), then the sections of body, a map.

    What isn't measured is written as null; a field that events lacks is left out.
    """
    present = [c for c in FIELDS if c in events.columns]
    # a field alone in an array is JSON whatever its type, null too; the array's brackets go
    json = [F.to_json(F.array(c), {"ignoreNullFields": "false"}) for c in present]
    lines = [F.concat(F.lit(f"{c}: "), F.substring(j, F.lit(2), F.length(j) - 2)) for c, j in zip(present, json, strict=True)]
    body = [F.concat(F.lit(f"## {s}\n"), F.coalesce(F.try_element_at("body", F.lit(s)), F.lit("")), F.lit("\n")) for s in sections]
    return events.select("id", F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"), F.concat_ws("\n", *body)).alias("note"))


def patch(events: DataFrame, changes: DataFrame, column: str) -> DataFrame:
    """events with one column from changes (id, column) where they have the id; all else stays."""
    new = changes.select("id", F.col(column).alias("_new"), F.lit(True).alias("_has"))
    out = events.join(new, "id", "left").withColumn(column, F.when(F.coalesce("_has", F.lit(False)), F.col("_new")).otherwise(F.col(column)))
    return out.select(*events.columns)


def watch_hits(rows: DataFrame, column: str, watched: list[tuple[str, list[str]]]) -> DataFrame:
    """rows with watch_hits: ids of watched entities of which a surface stands in the text.

    watched: (id, surfaces), a registry of bounded size. ASCII surfaces need bounds of words, others stand anywhere.
    """
    import re

    def pattern(surfaces: list[str]) -> str:
        return "(?i)" + "|".join(rf"(?<![A-Za-z0-9]){re.escape(s)}(?![A-Za-z0-9])" if s.isascii() else re.escape(s) for s in surfaces)

    found = [F.when(F.coalesce(column, F.lit("")).rlike(pattern(s)), i) for i, s in watched if s]
    return rows.withColumn("watch_hits", F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"))


def latest_pages(store: DataFrame) -> DataFrame:
    """The newest text of each name in a store (name, text, version)."""
    return store.groupBy("name").agg(F.max_by("text", "version").alias("text"))


def changed_pages(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rows of now (name, text) whose text before (name, text; one row a name) lacks or has otherwise.

    A null text differs from an empty one and equals a null one. Names are compared as they are; a null name is a name.
    """
    b = before.select(F.col("name").alias("_name"), F.col("text").alias("_text"), F.lit(True).alias("_known"))
    joined = now.select("name", "text").join(b, F.col("name").eqNullSafe(F.col("_name")), "left")
    return joined.filter(F.col("_known").isNull() | ~F.col("text").eqNullSafe(F.col("_text"))).select("name", "text")


def write_changed(now: DataFrame, path: str) -> int:
    """Append those pages of now (name, text) that changed to the store at path, as its next version; how many there are.

    Nothing is written if none changed, so a repeated write leaves the store alone. Rows that repeat a page count once.
    """
    spark, now = now.sparkSession, now.select("name", "text").distinct()
    try:
        store = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        store = spark.createDataFrame([], "name string, text string, version long")
    version = store.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1
    changed = changed_pages(now, latest_pages(store)).withColumn("version", F.lit(version).cast("long"))
    n = changed.count()
    if n:
        changed.write.mode("append").parquet(path)
    return n
