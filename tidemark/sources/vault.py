"""Files of a vault: day partitions of JSON lines, notes with front matter, ledgers; and how they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CORPUS = (
    "title string, summary string, url string, published string, author string, source_id string, track string, tier int, url_canonical string, first_observed_at string,"
    " is_new boolean, backfill boolean, author_kind string, entity_hits array<string>, entity_types array<string>, candidates array<string>"
)
_DAY = r"/(\d{4}-\d{2}-\d{2})/[^/]+\.jsonl$"


def read_corpus(spark: SparkSession, vault: str, strict: bool = False) -> DataFrame:
    """All rows of _corpus/<day>/<source>.jsonl with day and file; only folders named by a real date count.

    A malformed line ends a strict read, else it is dropped; blank lines are skipped.
    """
    lines = spark.read.text(f"{vault}/_corpus/*/*.jsonl").select("value", F.col("_metadata.file_path").alias("file")).filter(F.trim("value") != "")
    mode = {"mode": "FAILFAST"} if strict else {"columnNameOfCorruptRecord": "_bad"}
    parsed = lines.select("file", F.from_json("value", CORPUS if strict else f"{CORPUS}, _bad string", mode).alias("r")).select("r.*", "file")
    rows = parsed if strict else parsed.filter("_bad is null").drop("_bad")
    day = F.try_to_timestamp(F.regexp_extract("file", _DAY, 1), F.lit("yyyy-MM-dd"))
    return rows.withColumn("day", F.to_date(day)).filter("day is not null")


def latest_day(corpus: DataFrame) -> DataFrame:
    """The rows of the last day; on a partitioned table the day is pruned."""
    last = corpus.agg(F.max("day").alias("last"))
    return corpus.join(F.broadcast(last), F.col("day") == F.col("last"), "left_semi")


def first_by_url(corpus: DataFrame) -> DataFrame:
    """url to its first observation, title, and first summary that isn't empty, under both of a row's addresses."""
    each = corpus.select(F.explode(F.array_distinct(F.array_compact(F.array("url", "url_canonical")))).alias("key"), "title", "summary", "first_observed_at", F.struct("day", "file", "url").alias("ord"))
    filled = F.when(F.trim(F.coalesce("summary", F.lit(""))) != "", F.col("summary"))
    return each.groupBy(F.col("key").alias("url")).agg(
        F.min_by("first_observed_at", "ord").alias("first_observed_at"), F.min_by("title", "ord").alias("title"), F.min_by(filled, F.when(filled.isNotNull(), F.col("ord"))).alias("summary")
    )


def distinct_items(corpus: DataFrame) -> DataFrame:
    """The first row of each item of a source."""
    key = F.coalesce(F.nullif("url_canonical", F.lit("")), F.col("url"))
    first = W.partitionBy("source_id", "_key").orderBy("day", "file", "url", "title")
    return corpus.withColumn("_key", key).withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_key", "_n")


def observed(corpus: DataFrame) -> DataFrame:
    """(source_id, items, last_day): distinct items; a row without an address counts as one."""
    key = F.coalesce(F.nullif("url_canonical", F.lit("")), F.nullif("url", F.lit("")))
    return corpus.groupBy("source_id").agg((F.count_distinct(key) + F.count_if(key.isNull())).alias("items"), F.max("day").alias("last_day"))


def read_notes(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, front, body) of Markdown files; without delimiters all of it is body and front is null."""
    raw = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    head = r"(?s)^---\r?\n(.*?)\r?\n---\r?\n?(.*)$"
    matched = F.col("value").rlike(head)
    return raw.select("path", F.when(matched, F.regexp_extract("value", head, 1)).alias("front"), F.when(matched, F.regexp_extract("value", head, 2)).otherwise(F.col("value")).alias("body"))


def front_value(front: Column, key: str) -> Column:
    """A scalar of flat front matter, unquoted; null words and blanks are null."""
    v = F.trim(F.regexp_extract(F.coalesce(front, F.lit("")), rf"(?m)^{key}:[ \t]*(.*)$", 1))
    v = F.regexp_replace(v, r"^(['\"])(.*)\1$", "$2")
    return F.when(~v.isin("", "null", "None", "none", "~"), v)


LEDGER = ("at", "id", "field", "from", "to", "reason")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an append-only ledger with seq; a line that lacks a key is skipped, a key whose value is null is not."""
    raw = spark.read.text(path).withColumn("seq", F.monotonically_increasing_id())
    keys = F.expr("json_object_keys(value)")
    whole = F.size(F.array_intersect(keys, F.array(*[F.lit(k) for k in LEDGER]))) == len(LEDGER)
    fields = [F.get_json_object("value", f"$.{k}").alias(k) for k in LEDGER]
    return raw.filter(F.coalesce(whole, F.lit(False))).select("seq", *fields)


def append_ledger(rows: DataFrame, path: str) -> bool:
    """Append; no rows make no file."""
    if rows.isEmpty():
        return False
    rows.select(F.to_json(F.struct(*LEDGER), {"ignoreNullFields": "false"})).write.mode("append").text(path)
    return True


def carry_day_flags(now: DataFrame, before: DataFrame) -> DataFrame:
    """A second run of a day replaces the day's rows but keeps the first run's is_new and backfill."""
    key = ["source_id", "url_canonical"]
    held = before.groupBy(*key).agg(F.bool_or("is_new").alias("_new"), F.bool_or("backfill").alias("_stock"))
    out = now.join(held, key, "left").withColumns({"is_new": F.coalesce("_new", "is_new"), "backfill": F.coalesce("_stock", "backfill")})
    return out.select(*now.columns)


def write_day(rows: DataFrame, path: str) -> None:
    """Replace only the days and sources that rows holds."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "source_id").parquet(path)


def site_index(events: DataFrame) -> DataFrame:
    return events.select("id", "title", "date", "company", "track", "status", "confidence", "value").orderBy(F.desc("date"), "id")
