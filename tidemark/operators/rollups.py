"""What is reported of events, ledgers, runs and sources: queues, tallies, coverage, neighbours, courses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Blockers that no edit takes away, and what a company is called that nobody named.
TERMINAL = ("stale_backfill", "thin_by_policy")
GENERIC_COMPANY = "industry"


def review_queue(events: DataFrame, today: Column, terminal: tuple[str, ...] = TERMINAL) -> DataFrame:
    """One row on events (status, ingested, blockers, placeholder): sizes of the queue and its oldest ages in days.

    An event is terminal if it has blockers and all of them are. What has no date has no age, and is counted as undated.
    """
    waiting = F.col("status") == "review"
    done = (F.size("blockers") > 0) & (F.size(F.array_except("blockers", F.array(*map(F.lit, terminal)))) == 0)
    age, raw = F.datediff(today, F.col("ingested")), F.coalesce("placeholder", F.lit(False))

    def oldest(which: Column) -> Column:
        return F.coalesce(F.max(F.when(which, age)), F.lit(0))

    return events.agg(
        F.count_if(F.col("status") == "published").alias("published_total"), F.count_if(F.col("status") == "dropped").alias("dropped_total"),
        F.count_if(waiting).alias("review_total"), F.count_if(waiting & done).alias("review_terminal"), F.count_if(waiting & ~done).alias("review_actionable"),
        F.count_if(waiting & raw).alias("review_unenriched"), oldest(waiting & raw).alias("oldest_unenriched_days"), oldest(waiting & ~done).alias("oldest_stuck_days"),
        F.count_if(waiting & F.col("ingested").isNull()).alias("undated_review"), F.count_if(waiting & raw & F.col("ingested").isNull()).alias("unenriched_undated"),
    )


def blocker_counts(events: DataFrame) -> DataFrame:
    """(blocker, n) of events (status, blockers) under review, the most frequent first."""
    return events.filter("status = 'review'").select(F.explode("blockers").alias("blocker")).groupBy("blocker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "blocker")


def bound_by_source(evidence: DataFrame, events: DataFrame) -> DataFrame:
    """(source_id, bound, published): events that a source gives evidence for, each counted once, dropped ones never.

    Repeats of a source within an event go before the join, which is by event.
    """
    once = evidence.filter("source_id is not null").select("event", "source_id").distinct()
    alive = events.filter("status is null or status <> 'dropped'").select("event", "status")
    return once.join(alive, "event").groupBy("source_id").agg(F.count("*").alias("bound"), F.count_if(F.col("status") == "published").alias("published"))


def answer_tally(ledger: DataFrame, order: str = "seq") -> DataFrame:
    """(reason, demand, answered, unanswerable) on the latest values of a ledger (id, field, to, seq).

    A reason counts only while the verdict of its id is unanswerable; answered and unanswerable are of all ids. Without
    any reason there is one row with a null one.
    """
    last = ledger.filter(F.col("field").isin("verdict", "reason")).groupBy("id", "field").agg(F.max_by("to", order).alias("to"))
    by_id = last.groupBy("id").agg(F.max(F.when(F.col("field") == "verdict", F.col("to"))).alias("verdict"), F.max(F.when(F.col("field") == "reason", F.col("to"))).alias("reason"), F.bool_or(F.col("field") == "verdict").alias("has"))
    open_ = F.coalesce(F.col("verdict") == "unanswerable", F.lit(False))
    totals = by_id.agg(F.count_if("has").alias("answered"), F.count_if(open_).alias("unanswerable"))
    demand = by_id.filter(open_ & F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("demand"))
    return totals.join(demand, F.lit(True), "left").select("reason", F.coalesce("demand", F.lit(0)).alias("demand"), "answered", "unanswerable")


def coverage_sets(axis: DataFrame, claims: DataFrame) -> DataFrame:
    """axis (capability) with official, independent, unclaimed and official_only; claims: capability, kind (or null).

    Sources of neither kind count as claims, so that a capability that only they have isn't unclaimed.
    """
    counts = claims.groupBy("capability").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "official").alias("official"), F.count_if(F.col("kind") == "independent").alias("independent"))
    zero = F.lit(0).cast("long")
    every = axis.join(counts, "capability", "left").withColumns({c: F.coalesce(c, zero) for c in ("n", "official", "independent")})
    return every.select("capability", "official", "independent", (F.col("n") == 0).alias("unclaimed"), ((F.col("official") > 0) & (F.col("independent") == 0)).alias("official_only"))


def inventory(sources: DataFrame, column: str) -> DataFrame:
    """(value, n) of a column of a registry; what isn't filled in is told as such."""
    return sources.groupBy(F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit("not filled in")).alias("value")).agg(F.count("*").alias("n"))


def last_run(runs: DataFrame) -> DataFrame:
    """One row on the last of runs (run, source_id, status, items): sources, items, and those that answered with nothing.

    Runs are ordered by run; without any there is no row.
    """
    last = runs.agg(F.max("run").alias("run")).filter("run is not null")
    own = runs.join(F.broadcast(last), "run")
    quiet = (F.col("status") == 200) & (F.coalesce("items", F.lit(0)) == 0)
    return own.groupBy("run").agg(F.count("*").alias("sources"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"), F.array_sort(F.collect_list(F.when(quiet, F.col("source_id")))).alias("zero_yield"))


def summary(df: DataFrame, column: str) -> DataFrame:
    """(least, median, most) of a column; the median is the mean of the middle two, cut to a whole number."""
    return df.filter(F.col(column).isNotNull()).agg(F.min(column).alias("least"), F.percentile(column, 0.5).cast("int").alias("median"), F.max(column).alias("most"))


def exit_code(verdict: str, codes: dict[str, int], other: int = 4) -> Column:
    """Aggregate: the worst verdict's code. One that nobody has registered is no answer; no verdicts at all are 0."""
    known = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(F.max(F.coalesce(F.try_element_at(known, F.col(verdict)), F.lit(other))), F.lit(0))


def first_of_each(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each group, in the rows' order."""
    return rows.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy(order))).filter("_place = 1").drop("_place")


def course(evidence: DataFrame) -> DataFrame:
    """evidence (event, pos, at, coverage) with place, heading and origin.

    Items go by time, those without one last, then by pos. Only an observed event with several items has a course, and
    only its first item with a time is an origin: the first that was found needn't be where a thing began.
    """
    own = W.partitionBy("event")
    ordered = evidence.withColumns({"place": F.row_number().over(own.orderBy(F.col("at").asc_nulls_last(), "pos")), "_n": F.count("*").over(own)})
    moves = (F.col("_n") > 1) & (F.col("coverage") == "observed")
    return ordered.withColumns({"heading": F.when(moves, "course").otherwise("evidence"), "origin": F.coalesce(moves, F.lit(False)) & (F.col("place") == 1) & F.col("at").isNotNull()}).drop("_n")


def related(events: DataFrame, most: int = 4) -> DataFrame:
    """(event, other, place): of other events of the same track or company, the first in the list's order (ord).

    Whatever an event is related to first is among the first most + 1 of its track or its company, so two bounded lists
    are joined, never all pairs of a track.
    """

    def lists(key: str) -> DataFrame:
        # the smallest of a group are kept by bounded sorting, group by group
        rank = F.row_number().over(W.partitionBy(key).orderBy("ord", "event"))
        return events.filter(F.col(key).isNotNull()).select(key, "event", "ord").withColumn("_r", rank).filter(F.col("_r") <= most + 1).select(key, F.col("event").alias("other"), F.col("ord").alias("other_ord"))

    both = [events.select("event", key).join(lists(key), key).select("event", "other", "other_ord") for key in ("track", "company")]
    near = both[0].unionByName(both[1]).filter("event <> other").distinct()
    return near.withColumn("place", F.row_number().over(W.partitionBy("event").orderBy("other_ord", "other"))).filter(F.col("place") <= most).select("event", "other", "place")


def actors(dictionary: DataFrame, events: DataFrame) -> DataFrame:
    """(company, in_dictionary, events) of all companies that the dictionary or an event names; generic names are none."""
    named = events.select(F.trim("company").alias("company")).filter(f"company <> '' and company <> '{GENERIC_COMPANY}'").groupBy("company").agg(F.count("*").alias("n"))
    known = dictionary.select("company", F.lit(True).alias("known")).distinct()
    both = known.join(named, "company", "full_outer")
    return both.select("company", F.coalesce("known", F.lit(False)).alias("in_dictionary"), F.coalesce("n", F.lit(0).cast("long")).alias("events"))


def event_leads(evidence: DataFrame, corpus: DataFrame) -> DataFrame:
    """(event, lead_days): the least days from happened to an item's first observation in the corpus, null if none is known.

    evidence: event, url, happened. corpus: url, first_observed_at; of several rows of an address the earliest counts.
    """
    index = corpus.groupBy("url").agg(F.min("first_observed_at").alias("seen"))
    days = F.floor((F.unix_micros(F.col("seen").cast("timestamp")) - F.unix_micros(F.col("happened").cast("timestamp"))) / 86_400_000_000).cast("int")
    return evidence.join(index, "url", "left").groupBy("event").agg(F.min(days).alias("lead_days"))


def cell_differences(want: Column, got: Column) -> Column:
    """struct(missing, extra) of a cell that has to name a set exactly; null if it isn't filled in, which [] is not."""
    return F.when(got.isNotNull(), F.struct(F.array_sort(F.array_except(want, got)).alias("missing"), F.array_sort(F.array_except(got, want)).alias("extra")))


def may_write(exists: Column, reviewed: Column, force: Column) -> Column:
    """Why a finished text isn't written again; null if it may be."""
    return F.when(exists & reviewed & ~force, "already there")


def dirty(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Rows of now (key, signature) whose signature isn't the stored one; new keys are dirty as well."""
    old = before.select(key, F.col("signature").alias("_old"))
    return now.join(old, key, "left").filter(~F.col("signature").eqNullSafe(F.col("_old"))).drop("_old")


def advanced(state: DataFrame, now: DataFrame, at: Column, hours: float) -> DataFrame:
    """A board's stored state (key, value, ts): taken anew from now (key, value) if its newest row is older than so many hours.

    at is the present as a timestamp. An empty state counts as older than anything.
    """
    newest = F.broadcast(state.agg(F.max("ts").alias("_newest")))
    due = F.col("_newest").isNull() | ((F.unix_micros(at) - F.unix_micros("_newest")) / 3.6e9 >= hours)
    fresh = now.join(newest, F.lit(True)).filter(due).select("key", "value", at.alias("ts"))
    return fresh.unionByName(state.join(newest, F.lit(True)).filter(~due).select("key", "value", "ts"))


def found_once(results: DataFrame, excluded: tuple[str, ...]) -> DataFrame:
    """Results (ord, full_name, description) of several searches: each name at its first place, without excluded terms."""
    blob = F.lower(F.concat_ws(" ", "full_name", F.coalesce("description", F.lit(""))))
    clean = results.filter((F.coalesce("full_name", F.lit("")) != "") & ~F.exists(F.array(*map(F.lit, [x.lower() for x in excluded])).cast("array<string>"), lambda x: blob.contains(x)))
    return clean.groupBy("full_name").agg(F.min_by(F.struct(*[c for c in results.columns if c != "full_name"]), "ord").alias("_row")).select("full_name", "_row.*")


def share_of(rows: DataFrame, k: int, n: int) -> DataFrame:
    """The k-th of n shares (from 1) of rows (ord, from 0): neighbours go to different shares, each row to exactly one."""
    return rows.filter(F.pmod(F.col("ord"), F.lit(n)) == k - 1)


# Endings of files that a text can refer to, folders of what programs write, and statuses of open proposals.
ENDINGS = ("md", "py", "yaml", "yml", "json", "jsonl", "css", "html", "txt", "sh")
WRITTEN = ("_probe/", "_github/", "_corpus/", "_evidence_raw/", "dist/", "Events/", "Sources/", "Tracks/", "Actors/", "_dashboards/")
PROPOSALS = ("docs/design/", ("proposal", "review", "draft"))


def references(text: Column) -> Column:
    """Paths that a text refers to, each once, in order of appearance.

    A text is cut into pieces of characters that paths have, a piece at its slashes. Folders begin with a letter or an
    underscore; the file is the last part that such folders lead to and that holds a known ending, up to that ending.
    """
    endings = F.array(*[F.lit(f".{e}") for e in ENDINGS])

    def file_end(part: Column) -> Column:
        """Where the last known ending of a part ends, if anything stands before it; else 0."""
        backwards = F.reverse(part)
        ends = F.transform(endings, lambda e: F.struct((F.length(part) - F.position(F.reverse(e), backwards) + 1).alias("at"), F.position(F.reverse(e), backwards).alias("there"), F.length(e).alias("size")))
        return F.array_max(F.transform(ends, lambda x: F.when((x["there"] > 0) & (x["at"] > x["size"]), x["at"]).otherwise(0)))

    def path(piece: Column) -> Column:
        parts = F.split(piece, "/")
        led = F.transform(parts, lambda p, n: F.forall(F.slice(parts, F.lit(1), n), lambda f: f.rlike("^[A-Za-z_]")) & (n > 0))
        file = F.array_max(F.transform(parts, lambda p, n: F.when(F.get(led, n) & (file_end(p) > 0), n).otherwise(-1)))
        last = F.get(parts, file)
        return F.when(file > 0, F.concat(F.array_join(F.slice(parts, F.lit(1), file), "/"), F.lit("/"), F.substr(last, F.lit(1), file_end(last))))

    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9_./-]+"), lambda x: x.contains("/"))
    return F.array_distinct(F.array_compact(F.transform(pieces, path)))


def dead_references(files: DataFrame) -> DataFrame:
    """(path, target): references of files (path, text) to what isn't there.

    A target is looked for from the top and from beside the file, and only if its first part exists in one of these
    places. What programs write, one-letter examples and open proposals aren't held to it.
    """
    folder, statuses = PROPOSALS
    open_ = F.col("path").startswith(folder) & F.lower(F.regexp_extract(F.coalesce("text", F.lit("")), r"(?m)^status:\s*([A-Za-z_-]+)\s*$", 1)).isin(*statuses)
    parts = F.split("path", "/")
    here = files.filter(~open_).select("path", F.concat_ws("/", F.slice(parts, F.lit(1), F.size(parts) - 1)).alias("folder"), F.explode(references(F.col("text"))).alias("target"))
    stem = F.regexp_extract("target", r"([^/]+)\.[^.]+$", 1)
    asked = here.filter(~F.exists(F.array(*map(F.lit, WRITTEN)), lambda w: F.startswith(F.col("target"), w)) & (F.length(stem) > 1))
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat_ws("/", F.slice(parts, F.lit(1), n)))
    there = files.select(F.explode(prefixes).alias("place")).distinct()
    beside = F.when(F.col("folder") == "", F.col("target")).otherwise(F.concat_ws("/", "folder", "target"))
    tried = asked.withColumns({"beside": beside, "head": F.split_part("target", F.lit("/"), F.lit(1))})
    tried = tried.withColumn("head_beside", F.when(F.col("folder") == "", F.col("head")).otherwise(F.concat_ws("/", "folder", "head")))
    for column in ("target", "beside", "head", "head_beside"):
        tried = tried.join(there.select(F.col("place").alias(column), F.lit(True).alias(f"has_{column}")), column, "left")
    has = {c: F.coalesce(f"has_{c}", F.lit(False)) for c in ("target", "beside", "head", "head_beside")}
    return tried.filter((has["head"] | has["head_beside"]) & ~has["target"] & ~has["beside"]).select("path", "target").distinct()
