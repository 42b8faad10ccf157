"""Daily digests: how events relate, what to look back on, and the rules a draft must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_distances(events: DataFrame) -> DataFrame:
    """(a, b, distance, shared) for pairs of a day's events (id, day, fp, company, track, category): 1 the same thing,
    2 of one subject, 4 no common neighbour. A day has a few dozen events, so its pairs stay few."""
    cols = ("id", "fp", "company", "track", "category")
    a = events.select("day", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = events.select("day", *[F.col(c).alias(f"b_{c}") for c in cols])

    def same(c: str) -> Column:
        return (F.nullif(F.trim(f"a_{c}"), F.lit("")) == F.trim(f"b_{c}")) & ((F.col(f"a_{c}") != "industry") if c == "company" else F.lit(True))

    shared = F.array_compact(F.array(*[F.when(same(c), c) for c in ("company", "track", "category")]))
    both = a.join(b, "day").filter("a_id < b_id")
    distance = F.when(same("fp"), 1).when(F.size(shared) > 0, 2).otherwise(4)
    return both.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), distance.alias("distance"), F.when(same("fp"), "fingerprint").otherwise(F.array_join(shared, ",")).alias("shared"))


def retrospective(events: DataFrame, today: Column, group: str) -> DataFrame:
    """(group, id, rule): the oldest signal that we announced and that hasn't come, else the best event not yet shown.

    events: id, group, day, value, voices, next_signal, featured.
    """
    due = F.coalesce((F.trim("next_signal") != "") & (F.col("voices") < 2) & (F.datediff(today, "day") >= 3), F.lit(False))
    age, value = F.datediff(today, "day"), F.coalesce("value", F.lit(0))
    rank = F.struct(due.alias("due"), F.when(due, age).alias("age"), F.when(~due, value).alias("value"), age.alias("older"), F.negate("id").alias("id"))
    best = events.filter(~F.coalesce("featured", F.lit(False))).groupBy(group).agg(F.max(rank).alias("b"))
    return best.select(group, F.negate("b.id").alias("id"), F.when(F.col("b.due"), "pending_signal").otherwise("highest_value_unfeatured").alias("rule"))


DASHES, BOLD, QUESTIONS, CONTRAST, COUNTER = 8, 12, 2, 1, 15
# Phrasing that closes an inference or sets up a false contrast.
CLOSED = r"(?i)毫無疑問|顯而易見|無庸置疑|必然|註定|勢必|毋庸置疑"
CONTRASTS = "不是.{1,20}而是"


def language_density(df: DataFrame, column: str) -> DataFrame:
    """df with counts and densities a thousand characters, and whether they exceed the limits."""
    t = F.coalesce(F.col(column), F.lit(""))
    per_thousand = 1000.0 / F.greatest(F.length(t), F.lit(1))
    dashes, bold = F.regexp_count(t, F.lit("[—-]")), F.regexp_count(t, F.lit(r"\*\*"))
    questions, contrasts = F.regexp_count(t, F.lit(r"[?？]")), F.regexp_count(t, F.lit(CONTRASTS))
    rejected = (dashes * per_thousand > DASHES) | (bold / 2 * per_thousand > BOLD) | (questions > QUESTIONS) | (contrasts > CONTRAST) | t.rlike(CLOSED)
    return df.withColumns(
        {"dash_density": F.round(dashes * per_thousand, 3), "bold": bold.cast("long"), "questions": questions.cast("long"), "contrasts": contrasts, "rejected": rejected}
    )


def draft_rejects(sections: DataFrame, items: DataFrame) -> DataFrame:
    """(date, code, detail) of what a draft breaks.

    sections: date, id, layer, text, evidence (ids), basis, counter, source_url. items: date, id, urls, withheld.
    """
    known = items.groupBy("date").agg(F.collect_set("id").alias("known"), F.flatten(F.collect_list("urls")).alias("urls"))
    s = sections.join(known, "date", "left")
    blank = {c: F.trim(F.coalesce(c, F.lit(""))) == "" for c in ("basis", "counter", "source_url")}
    unknown = F.array_except("evidence", F.coalesce("known", F.array().cast("array<string>")))
    layer = F.col("layer")
    rules = F.array_compact(
        F.array(
            F.when(~layer.isin("A", "B", "C", "D"), "bad_layer"), F.when(F.size(unknown) > 0, "unknown_event"),
            F.when(layer.isin("A", "D") & (F.size("evidence") == 0), "layer_needs_evidence"), F.when((layer == "B") & blank["basis"], "b_without_basis"),
            F.when((layer == "C") & blank["counter"], "c_without_counter").when((layer == "C") & (F.length(F.trim("counter")) < COUNTER), "counter_too_thin"),
            F.when((layer == "D") & (blank["source_url"] | ~F.coalesce(F.array_contains("urls", F.col("source_url")), F.lit(False))), "d_without_source_url"),
            F.when(F.col("text").rlike(CLOSED), "closed_inference"),
        )
    )
    own = s.select("date", F.explode(rules).alias("code"), F.col("id").alias("detail"))
    repeated = sections.groupBy("date", "id").count().filter("count > 1").select("date", F.lit("duplicate_id").alias("code"), F.col("id").alias("detail"))
    used = sections.select("date", F.explode("evidence").alias("id")).distinct()
    left = items.join(used, ["date", "id"], "left_anti").select("date", F.lit("unaccounted_material").alias("code"), F.col("id").alias("detail"))
    return own.unionByName(repeated).unionByName(left)


def review_state(rejected: Column, stale: Column, missing: Column) -> Column:
    """What a draft's review comes to: a rejection counts more than staleness, that more than a missing cell."""
    return F.when(rejected, "rejected").when(stale, "stale").when(missing > 0, "draft").otherwise("reviewed")
