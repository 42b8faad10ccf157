"""Append-only ledgers, source health, snapshots and their rankings, supply against demand, dictionary gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    """The last row of each key; one pass with partial aggregation, no sort."""
    every = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(every, F.col(seq)).alias("_row")).select("_row.*")


def breaks(rows: DataFrame) -> DataFrame:
    """Rows (id, field, seq, from, to) whose `from` isn't the `to` of the row before."""
    before = F.lag("to").over(W.partitionBy("id", "field").orderBy("seq"))
    n = F.row_number().over(W.partitionBy("id", "field").orderBy("seq"))
    return rows.withColumns({"_before": before, "_n": n}).filter((F.col("_n") > 1) & ~F.col("from").eqNullSafe(F.col("_before"))).drop("_before", "_n")


# What a run's status means, and the points it gives.
NEUTRAL = ("401", "403", "429", "robots_disallow", "robots_unknown", "unsupported_adapter", "skipped_lifecycle")
POINTS = (("success", 8), ("not_modified", 3), ("failure", -15), ("severe_failure", -25))
START, DEGRADE, QUARANTINE, RECOVER = 100, 2, 5, 3
RUNNING = ("active", "degraded", "probing")


def outcome(status: Column) -> Column:
    """Of a status number or word, given as text; what isn't known is neutral."""
    return (
        F.when(status.isin(*NEUTRAL), "neutral").when(status == "200", "success").when(status == "304", "not_modified").when(status.isin("404", "410"), "severe_failure")
        .when(status.rlike("^5[0-9][0-9]$") | (status == "error"), "failure").otherwise("neutral")
    )


#: Runs that are folded as one array at most, about; a source with more is split by time.
CHUNK = 20_000
#: What a score can't reach.
FAR = 1 << 30


def _step() -> Column:
    """A run as a step: x -> min(high, max(low, x + points)), what it does to both streaks, and its counts."""
    points, good, bad = F.lit(0), F.col("outcome").isin("success", "not_modified"), F.col("outcome").isin("failure", "severe_failure")
    for name, n in POINTS:
        points = F.when(F.col("outcome") == name, n).otherwise(points)
    one = lambda x: F.when(x, 1).otherwise(0)
    return _steps(points, F.lit(0), F.lit(100), F.coalesce(good, F.lit(False)), one(bad), F.coalesce(bad, F.lit(False)), one(good), one(~F.coalesce(good | bad, F.lit(False))), F.lit(1))


def _steps(*values: Column) -> Column:
    names = ("points", "low", "high", "ends_failures", "failures", "ends_successes", "successes", "neutral", "runs")
    return F.struct(*[v.cast("boolean" if n.startswith("ends") else "int").alias(n) for n, v in zip(names, values, strict=True)])


def then(a: Column, b: Column) -> Column:
    """Steps a and then b as one step: such steps compose, whatever is bracketed first."""
    within = lambda x: F.least(b["high"], F.greatest(b["low"], x + b["points"]))
    return _steps(
        a["points"] + b["points"], within(a["low"]), within(a["high"]), a["ends_failures"] | b["ends_failures"], F.when(b["ends_failures"], b["failures"]).otherwise(a["failures"] + b["failures"]),
        a["ends_successes"] | b["ends_successes"], F.when(b["ends_successes"], b["successes"]).otherwise(a["successes"] + b["successes"]), a["neutral"] + b["neutral"], a["runs"] + b["runs"],
    )


def _folded(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """rows (key…, order, step) as one step a key."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(order, "step"))), lambda x: x["step"])
    nothing = _steps(F.lit(0), F.lit(-FAR), F.lit(FAR), F.lit(False), F.lit(0), F.lit(False), F.lit(0), F.lit(0), F.lit(0))
    return rows.groupBy(*key).agg(F.aggregate(ordered, nothing, then).alias("step"))


def course(runs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(source, step): all runs (source, seq, outcome) of each source as one step, whatever their number.

    Rows are range-partitioned by source and time into parts of about `chunk` rows; a source's rows in a part are folded
    as an array, and then its parts, of which there are as many as the source has chunks. So a source with a third of all
    rows is many parts, and no array holds it whole.
    """
    parts = max(1, -(-runs.count() // chunk))
    steps = runs.select("source", "seq", _step().alias("step"))
    cut = steps.repartitionByRange(parts, "source", "seq").withColumn("part", F.spark_partition_id()) if parts > 1 else steps.withColumn("part", F.lit(0))
    return _folded(_folded(cut, ["source", "part"], "seq"), ["source"], "part")


def health_of(steps: DataFrame) -> DataFrame:
    """(source, step) to score, runs, neutral_runs, consecutive failures and successes of each source."""
    score = F.least(F.col("step.high"), F.greatest(F.col("step.low"), START + F.col("step.points")))
    return steps.select(
        "source", score.alias("score"), F.col("step.runs").alias("runs"), F.col("step.neutral").alias("neutral_runs"), F.col("step.failures").alias("consecutive_failures"), F.col("step.successes").alias("consecutive_successes")
    )


def health(runs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """runs (source, seq, outcome) to the health of each source; seq is unique within a source.

    The score is clamped at each run, so it is a fold over the ordered runs, made of steps that compose. A null outcome
    is neutral; a null source is one like others. Empty table: no rows.
    """
    return health_of(course(runs, chunk))


def last_streak(runs: DataFrame, of: tuple[str, ...]) -> DataFrame:
    """(source, streak): how many runs at the end have one of these outcomes; neutral runs neither count nor break."""
    counted = runs.filter("outcome <> 'neutral'").withColumn("hit", F.col("outcome").isin(*of))
    after = counted.withColumn("breaks", F.sum((~F.col("hit")).cast("int")).over(W.partitionBy("source").orderBy(F.desc("seq"))))
    return after.groupBy("source").agg(F.count_if((F.col("breaks") == 0) & F.col("hit")).cast("int").alias("streak"))


def health_decision(lifecycle: Column, failures: Column, successes: Column, degraded_by: Column, prior: Column) -> Column:
    """What becomes of a source: only demotions that health itself made are undone."""
    back = F.concat(F.lit("restore:"), F.when(prior.isin("probing", "active"), prior).otherwise("probing"))
    return (
        F.when(~F.coalesce(lifecycle, F.lit("")).isin(*RUNNING), "skip")
        .when(lifecycle == "degraded", F.when(failures >= QUARANTINE, "quarantine_candidate").when((degraded_by == "health") & (successes >= RECOVER), back).otherwise("keep"))
        .when(failures >= DEGRADE, "degrade").otherwise("keep")
    )


SURGE_FLOOR, SHORTEST_DAYS, TOP = 200, 0.5, 25


def velocities(now: DataFrame, before: DataFrame) -> DataFrame:
    """now (name, stars, at) against before (name, prev_stars, prev_at): delta, velocity a day, surge in percent a day.

    Without an earlier snapshot nothing is measured: null, not 0. Small repositories have no surge.
    """
    days = (F.unix_micros("at") - F.unix_micros("prev_at")) / 86_400_000_000
    floored = F.greatest(days, F.lit(SHORTEST_DAYS))
    both = now.join(before, "name", "left").withColumn("delta", F.col("stars") - F.col("prev_stars"))
    return both.withColumns(
        {
            "baseline_days": F.bround(days, 1), "velocity": F.bround(F.col("delta") / floored, 1),
            "surge": F.when(F.col("prev_stars") >= SURGE_FLOOR, F.bround(100.0 * F.col("delta") / floored / F.col("prev_stars"), 2)),
        }
    )


def board(rows: DataFrame, axis: str, top: int = TOP) -> DataFrame:
    """The first rows by velocity (then stars) or by surge, with their rank; ties go by name."""
    order = [F.col("velocity").desc_nulls_last(), F.desc("stars"), F.col("name")] if axis == "velocity" else [F.desc("surge"), F.col("name")]
    shown = (rows if axis == "velocity" else rows.filter("surge is not null")).orderBy(*order).limit(top)
    # a board has at most `top` rows, so its ranks may be given in one task
    return shown.withColumn("rank", F.row_number().over(W.orderBy(*order)))


def rank_move(known: Column, has_rank: Column, prev: Column, now: Column) -> Column:
    """Six states, none of which is 0: not seen before, no rank kept, off the board before, up, down, flat."""
    return (
        F.when(~F.coalesce(known, F.lit(False)), "first_seen").when(~F.coalesce(has_rank, F.lit(False)), "no_baseline").when(prev.isNull(), "entered")
        .when(prev > now, "up").when(prev < now, "down").otherwise("flat")
    )


def interleave(boards: list[DataFrame]) -> DataFrame:
    """(pos, board, name): boards (name, rank) one row after the other in turn, each name once."""
    every = None
    for n, b in enumerate(boards):
        part = b.select("name", F.col("rank").alias("pos"), F.lit(n).alias("board"))
        every = part if every is None else every.unionByName(part)
    first = every.groupBy("name").agg(F.min(F.struct("pos", "board")).alias("at"))
    return first.select("at.pos", "at.board", "name")


MIN_ANSWERS, AMBER, RED = 10, 1.0, 3.0


def gap_light(demand: Column, independent: Column, measurable: Column, amber: float = AMBER, red: float = RED) -> Column:
    """How demand for a capability compares with independent supply."""
    ratio = F.try_divide(demand.cast("double"), independent)
    return (
        F.when(~measurable, "unmeasurable").when((independent == 0) & (demand > 0), "red").when(demand == 0, "white").when(ratio > red, "red").when(ratio > amber, "amber").otherwise("green")
    )


MIN_HITS, MIN_SOURCES = 3, 2


def candidate_tally(rows: DataFrame) -> DataFrame:
    """rows (ord, source, candidates) to (candidate, hits, sources, first_seen)."""
    each = rows.select("ord", "source", F.posexplode("candidates").alias("pos", "candidate"))
    return each.groupBy("candidate").agg(F.count("*").alias("hits"), F.count_distinct("source").alias("sources"), F.min(F.struct("ord", "pos")).alias("first_seen"))


def unbucketed(status: Column, buckets: tuple[str, ...]) -> Column:
    return ~F.coalesce(status.isin(*buckets), F.lit(False))
