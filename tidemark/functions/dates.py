"""Dates and times: two text formats, UTC throughout, differences that floor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?\s*(Z|[+-]\d{2}:?\d{2})?$"


def parse_iso(text: Column) -> Column:
    """An ISO 8601 date or time; without an offset it is UTC; anything else is null."""
    t = F.trim(text.cast("string"))
    return F.when(t.rlike(ISO), t.try_cast("timestamp"))


def parse_any(text: Column) -> Column:
    """An RFC 822 time (weekday or none, named zone or offset) or an ISO 8601 one; else null."""
    bare = F.regexp_replace(F.trim(text.cast("string")), r"^[A-Za-z]{3},\s*", "")
    rfc = [F.try_to_timestamp(bare, F.lit(p)) for p in ("d MMM yyyy HH:mm:ss xx", "d MMM yyyy HH:mm:ss z")]
    return F.when(bare.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} "), F.coalesce(*rfc)).otherwise(parse_iso(text))


def micros_between(later: Column, earlier: Column) -> Column:
    # tables may hold times without a zone; they are UTC
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days from earlier to later, rounded down also below zero; null if either is."""
    return F.floor(micros_between(later, earlier) / DAY_MICROS).cast("int")


def hours_between(a: Column, b: Column) -> Column:
    return F.abs(micros_between(a, b)) / 3_600_000_000


def display_time(ts: Column) -> Column:
    """Shown in UTC+8 with a label, whatever the session's zone is."""
    return F.concat(F.date_format(ts + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd HH:mm"), F.lit(" UTC+8"))


# English month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_BARRIER = "|"


def _date_words(text: Column) -> Column:
    """The words and numbers of a text; a mark between them that no date has is a word of its own."""
    low = F.lower(F.coalesce(text, F.lit("")))
    # a point may follow a short month, a comma a day
    joined = F.regexp_replace(F.regexp_replace(low, r"(?<=[a-z])\.(?=\s)", ""), r"(?<=[a-z0-9])\s*,(?=\s)", "")
    return F.array_remove(F.split(F.regexp_replace(joined, r"[^a-z0-9\s]+", f" {_BARRIER} "), r"\s+"), "")


def _bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """make(value) with value computed once: what a lambda takes from outside is computed again for each element."""
    return F.get(F.transform(F.array(value), make), 0)


def _month(word: Column) -> Column:
    names = {name: n for n, full in enumerate(MONTHS, 1) for name in (full, full[:3])} | {"sept": 9}
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), word)


def _day(word: Column) -> Column:
    return F.when(word.rlike("^[0-9]{1,2}(st|nd|rd|th)?$"), F.regexp_extract(word, "^[0-9]+", 0).cast("int"))


def _year(word: Column) -> Column:
    return F.when(word.rlike("^20[0-9]{2}$"), word.cast("int"))


def _first(words: Column, *kinds) -> Column:
    """Where in words the first run of these kinds stands; null if there is none."""
    at = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1))

    def here(i: Column) -> Column:
        found = F.lit(True)
        for n, kind in enumerate(kinds):
            found = found & kind(F.get(words, i + n)).isNotNull()
        return found

    return F.get(F.filter(at, here), 0)


def _day_of(year: Column, month: Column, day: Column) -> Column:
    return F.date_format(F.call_function("try_make_timestamp", year, month, day, F.lit(0), F.lit(0), F.lit(0)), "yyyy-MM-dd")


def entry_date(text: Column, year_hint: Column | None = None) -> Column:
    """struct(iso, precision, year_source) of the first date in a text.

    A month, day and year; else a month and year; else a month and day, which takes its year from the hint alone. A day
    that doesn't exist gives none.
    """
    hint = year_hint.cast("int") if year_hint is not None else F.lit(None).cast("int")
    return _bound(_date_words(text), lambda words: _dated(words, hint))


def _dated(words: Column, hint: Column) -> Column:
    whole, monthly, bare = _first(words, _month, _day, _year), _first(words, _month, _year), _first(words, _month, _day)

    def word(at: Column, n: int) -> Column:
        return F.get(words, at + n)

    def out(iso: Column, precision: str, source: str) -> Column:
        return F.when(iso.isNotNull(), F.struct(iso.alias("iso"), F.lit(precision).alias("precision"), F.lit(source).alias("year_source")))

    exact = out(_day_of(_year(word(whole, 2)), _month(word(whole, 0)), _day(word(whole, 1))), "day", "explicit")
    short = out(F.concat_ws("-", _year(word(monthly, 1)).cast("string"), F.lpad(_month(word(monthly, 0)).cast("string"), 2, "0")), "month", "explicit")
    hinted = out(_day_of(hint, _month(word(bare, 0)), _day(word(bare, 1))), "day", "section")
    found = F.when(whole.isNotNull(), exact).when(monthly.isNotNull(), short).when(bare.isNotNull(), hinted)
    return F.coalesce(found, F.struct(F.lit(None).cast("string").alias("iso"), F.lit("none").alias("precision"), F.lit("none").alias("year_source")))


def is_date_only(text: Column) -> Column:
    """Whether a text is nothing but a date, as entries of an index are."""
    return _bound(F.filter(_date_words(F.concat_ws(" ", text, F.lit(""))), lambda w: w != ""), _only_date)


def _only_date(words: Column) -> Column:
    n = F.size(words)
    month, second, third = _month(F.get(words, 0)), F.get(words, 1), F.get(words, 2)
    return F.coalesce(month.isNotNull() & (((n == 3) & _day(second).isNotNull() & _year(third).isNotNull()) | ((n == 2) & (_day(second).isNotNull() | _year(second).isNotNull()))), F.lit(False))


def anchor_gap(anchors: Column, shown: Column) -> Column:
    """struct(anchor_dates, text_dates, orphan_dates): days that a page's text names, and those that no anchor of it does.

    anchors: the page's anchor names; shown: its visible text.
    """
    marks = F.array_distinct(F.filter(F.transform(anchors, lambda a: entry_date(F.replace(a, F.lit("-"), F.lit(" ")))["iso"]), lambda d: d.isNotNull()))
    days = _bound(_date_words(shown), _days)

    def sizes(x: Column) -> Column:
        orphans = F.array_except(x["days"], x["marks"])
        return F.struct(F.size(x["marks"]).alias("anchor_dates"), F.size(x["days"]).alias("text_dates"), F.size(orphans).alias("orphan_dates"))

    return _bound(F.struct(marks.alias("marks"), days.alias("days")), sizes)


def _days(words: Column) -> Column:
    """The different days that words name in full."""
    at = F.when(F.size(words) > 2, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    whole = F.filter(at, lambda i: _month(F.get(words, i)).isNotNull() & _day(F.get(words, i + 1)).isNotNull() & _year(F.get(words, i + 2)).isNotNull())
    days = F.transform(whole, lambda i: _day_of(_year(F.get(words, i + 2)), _month(F.get(words, i)), _day(F.get(words, i + 1))))
    return F.array_distinct(F.filter(days, lambda d: d.isNotNull()))
