"""Signals of a stream attached to events of a stream, with events that stay open as long as something may attach.

Both sides are keyed by what a match needs in common, a fingerprint or a token and a 96-hour slot, and joined on the key
within the longest distance of times. Spark's state of the join is the table of open events: an event leaves it when the
watermark has passed all signals that could attach to it, and a signal is told once no event can come that is better. So
the answer doesn't depend on how rows are split into batches, as long as none is later than the watermark allows.

Rows alike in title and time are one class, made as soon as the watermark has passed them: the join's state and its rows
grow with classes, not with copies. The signals of a class are carried once, by a row of the class's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.numbers import jaccard
from tidemark.operators import events as rules


def _keys(slots: Column) -> Column:
    """What one side of a match must share with the other: f: and the fingerprint, or t:, slot and token."""
    by_token = F.flatten(F.transform(slots, lambda s: F.transform("tokens", lambda t: F.concat_ws(":", F.lit("t"), s.cast("string"), t))))
    return F.concat(F.array_compact(F.array(F.concat(F.lit("f:"), "fp"))), by_token)


def _classes(rows: DataFrame, name: str, around: tuple[int, ...], late: str, ascii_only: bool, *more: Column) -> DataFrame:
    """Classes of copies with a row a key, and one with a key of the class's own, which no other side has."""
    told = rows.filter("at is not null").withWatermark("at", late).groupBy("at", "title").agg(F.min("id").alias("low"), F.max("id").alias("high"), *more)
    slot = F.floor(F.unix_seconds("at") / (rules.BY_TITLE_HOURS * 3600))
    # null keys would be taken out before the watermark has seen them
    own = F.array(F.concat_ws(":", F.lit(name), F.coalesce(F.col("low").cast("string"), F.lit(""))))
    keyed = rules.keyed(told, ascii_only).withColumn("key", F.explode(F.concat(own, _keys(F.array(*[slot + d for d in around])))))
    return keyed.select(*[F.col(c).alias(f"{name}_{c}") for c in (*told.columns, "tokens", "fp", "bucket", "key")])


def attach_stream(signals: DataFrame, events: DataFrame, similar: float = rules.SIMILAR, late: str = "1 day", ascii_only: bool = False) -> DataFrame:
    """(signal, at, event, similarity) of each signal, once: its best event, or null without one or if others are as good.

    signals and events are streams of (id long, title, at); rows later than `late` behind their stream are dropped. The
    rule is that of match() and attach(): events are open for 96 hours by title, 7 days for incidents by identity, 21 days
    for others. A signal without a time has no event and isn't told. Write it in append mode.
    """
    s, e = _classes(signals, "s", (0,), late, ascii_only, F.collect_set("id").alias("ids")), _classes(events, "e", (-1, 0, 1), late, ascii_only)
    s = s.withColumn("s_ids", F.when(F.col("s_key").startswith("s:"), F.col("s_ids")))
    apart = f"INTERVAL {rules.IDENTITY_HOURS} HOURS"
    both = s.join(e, F.expr(f"s_key = e_key AND e_at >= s_at - {apart} AND e_at <= s_at + {apart}"), "left_outer")
    hours = dates.hours_between(F.col("s_at"), F.col("e_at"))
    like = F.round(jaccard(F.col("s_tokens"), F.col("e_tokens")), 6)
    same_bucket = F.col("s_bucket") == F.col("e_bucket")
    within = F.when(F.col("s_bucket") == "incident", rules.INCIDENT_HOURS).otherwise(rules.IDENTITY_HOURS)
    by_fp = (F.col("s_fp") == F.col("e_fp")) & same_bucket & (hours <= within)
    by_title = (F.col("s_fp").isNull() | F.col("e_fp").isNull()) & (hours <= rules.BY_TITLE_HOURS) & (jaccard(F.col("s_tokens"), F.col("e_tokens")) >= similar)
    fits = F.coalesce(by_fp, F.lit(False)) | F.coalesce(by_title, F.lit(False))
    rank = F.struct(F.coalesce(F.col("s_fp") == F.col("e_fp"), F.lit(False)).alias("same_fp"), same_bucket.alias("same_bucket"), like.alias("similarity"))
    # the same best rank with the largest and with the smallest identifier: one event if both are the same
    ends = [F.when(fits, F.struct(rank.alias("rank"), x.alias("event"))).alias(k) for k, x in (("top", F.col("e_high")), ("low", -F.col("e_low")))]
    pairs = both.select(F.col("s_at").alias("at"), F.col("s_title").alias("title"), F.col("s_ids").alias("ids"), *ends)
    told = pairs.groupBy("at", "title").agg(F.first("ids", True).alias("ids"), F.max("top").alias("top"), F.max("low").alias("low"))
    alone = F.col("top.event") == -F.col("low.event")
    return told.select(F.explode("ids").alias("signal"), "at", F.when(alone, F.col("top.event")).alias("event"), F.when(alone, F.col("top.rank.similarity")).alias("similarity"))


def edition_days(passed: DataFrame, late: str = "1 day") -> DataFrame:
    """(edition, n, open) of a stream of events that passed the gate: id, at, open. An event is in one edition, once.

    An event that is delivered again within `late` doesn't count again; a day is told when the watermark has passed it,
    and never changes after. Events without a time of passing are in no edition. Write it in append mode.
    """
    once = passed.filter("at is not null").withWatermark("at", late).dropDuplicatesWithinWatermark(["id"])
    days = once.groupBy(F.window("at", "1 day")).agg(F.count("*").alias("n"), F.count_if("open").alias("open"))
    return days.select(F.col("window.start").cast("date").alias("edition"), "n", "open")
