"""Repeated windows by a depth-limited radix sort of suffixes.

Suffixes are ordered through `threshold` bytes only, by most-significant-digit passes, and a suffix leaves the order as
soon as its group can't hold another document:

1. The first digit of a suffix is a gram of DIGIT bytes within its window, the one with the smallest fingerprint. It
   depends on the window alone, so equal windows have equal digits, and the suffixes that follow each other in a text
   share one: a run of about a dozen suffixes is one row of the pass. Runs whose digit one row alone has are finished.
2. The second digit is the whole stretch that a run's windows cover. In a group of equal stretches all but the smallest
   document lose all windows of the run; the smallest stays in the order if its first digit has other stretches.
3. The third digit is the stretch that WIDTH neighbouring windows of a run have in common. Most of those left end here:
   they have a gram in common by chance, and nothing around it.
4. The last digit is the window itself, for what is left: equal groups are exactly the repeated windows.

Digits are 64-bit fingerprints; a group of pass 2 or 4 is equal in two of them with different bases. A task sends one
row for equal digits of what it holds, and marks the others as answered, so a passage that a third of all documents
share isn't a third of a group.

Each pass ends in a table in the shared folder, and its shuffle files go as soon as that is written. What a row is asked
about is half a fingerprint: one that meets by chance is work for the next pass, whose digits are whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import tune, written

THRESHOLD = 50
#: Bytes of the first digit: with fewer, runs are longer and more digits repeat by chance.
DIGIT = 26
#: Windows that have a third digit in common.
WIDTH = 9
#: Bytes whose windows are looked at together; a longer text is cut, with THRESHOLD - 1 bytes in common.
STEP = 1 << 16
#: Rows that a task holds to find equal digits among them.
HELD = 400_000

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads each value over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


@cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, powers of the base, and of its inverse modulo 2^64."""
    size = 2 * STEP + 2 * THRESHOLD
    up, down = (np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64)))) for b in (base, pow(base, -1, 1 << 64)))
    return _mixed(_mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))), up, down


def _counted(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All whole numbers from each first to before its end."""
    size = end - first
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


class Prints:
    """Fingerprints of any stretch of bytes, from sums over their prefixes."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        values, up, self.down = _powers(base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])

    def at(self, start: np.ndarray, length: int) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * self.down[start])


class Runs:
    """The runs of suffixes of several stretches of text that lie end to end: row, first and last start, digits."""

    def __init__(self, pieces: list[tuple[int, int, memoryview]], threshold: int) -> None:
        """pieces: the row, the place in its text, and at least `threshold` bytes."""
        self.threshold, digit = threshold, threshold * DIGIT // THRESHOLD
        data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        self.rows, self.places = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
        ends = np.cumsum([len(p[2]) for p in pieces])
        self.starts = ends - [len(p[2]) for p in pieces]
        self.data, self._prints = data, []
        grams = self.prints(1)[0].all(digit)
        # the smallest fingerprint, of equal ones the first: its place is the low half
        least, width, spread = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), 1, threshold - digit + 1
        while 2 * width <= spread:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < spread:
            least = np.minimum(least[: len(least) - (spread - width)], least[spread - width :])
        anchor = (least & _LOW).astype(np.int64)
        # no window reaches from one stretch into the next
        for end in ends[:-1]:
            anchor[end - threshold + 1 : end] = -1
        edges = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, [len(anchor)]))
        inside = anchor[edges[:-1]] >= 0
        self.first, self.end = edges[:-1][inside], edges[1:][inside]
        self.anchor = anchor[self.first]
        self.digit = grams[self.anchor]
        self.piece = np.searchsorted(self.starts, self.first, "right") - 1
        self.row = self.rows[self.piece]

    def prints(self, n: int) -> list[Prints]:
        """With the first n bases; made when they are asked for, as most passes need one."""
        self._prints += [Prints(self.data, b) for b in _BASES[len(self._prints) : n]]
        return self._prints[:n]

    def stretches(self, which: np.ndarray, n: int) -> list[np.ndarray]:
        """n fingerprints of the whole stretch of each of these runs: its first and last window overlap or are one."""
        first, end = self.first[which], self.end[which]
        shape = ((end - first) * 64 + self.anchor[which] - first).astype(np.uint64)
        return [_mixed(p.at(first, self.threshold) * np.uint64(3) + _mixed(p.at(end - 1, self.threshold) + shape)) for p in self.prints(n)]

    def windows(self, which: np.ndarray) -> np.ndarray:
        """The start of each window of these runs."""
        return _counted(self.first[which], self.end[which])

    def shares(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Parts of these runs, of WIDTH windows at most: run, first and last start, and the fingerprint of what they have in common."""
        low, high = (self.anchor - self.end + 1)[which] // WIDTH, (self.anchor - self.first)[which] // WIDTH
        part, run = _counted(low, high + 1), np.repeat(which, high + 1 - low)
        anchor = self.anchor[run]
        first, end = np.maximum(anchor - part * WIDTH - WIDTH + 1, self.first[run]), np.minimum(anchor - part * WIDTH + 1, self.end[run])
        common = self.prints(1)[0].at(anchor - part * WIDTH, self.threshold - WIDTH + 1)
        return run, first, end, _mixed(common + part.astype(np.uint64) * np.uint64(_BASES[1]))

    def place(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of each start and where it is in that row's text."""
        piece = np.searchsorted(self.starts, start, "right") - 1
        return self.rows[piece], start - self.starts[piece] + self.places[piece]


def runs_of(texts: pa.Array, threshold: int, asked: np.ndarray | None = None) -> Iterator[Runs]:
    """The runs of a batch's texts (of those asked for), about STEP bytes at a time."""
    pieces, size = [], 0
    for row, text in enumerate(texts):
        if not text.is_valid or (asked is not None and not asked[row]):
            continue
        whole = memoryview(text.as_buffer())
        for at in range(0, len(whole) - threshold + 1, STEP):
            pieces.append((row, at, whole[at : at + STEP + threshold - 1]))
            size += len(pieces[-1][2])
            if size >= STEP:
                yield Runs(pieces, threshold)
                pieces, size = [], 0
    if pieces:
        yield Runs(pieces, threshold)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class Asked:
    """Which values each row of a batch asks for, from a column of lists: of whole values, or of their upper halves."""

    def __init__(self, lists: pa.Array) -> None:
        sizes = np.diff(np.asarray(lists.offsets)) if len(lists) else np.zeros(0, np.int64)
        self.rows = sizes > 0
        half = pa.types.is_int32(lists.type.value_type)
        self.shift = np.uint64(32 if half else 0)
        values = np.asarray(lists.flatten()).view(np.uint32 if half else np.uint64).astype(np.uint64)
        self.keys = np.unique(self._key(np.repeat(np.arange(len(sizes)), sizes), values))

    @staticmethod
    def _key(row: np.ndarray, value: np.ndarray) -> np.ndarray:
        return _mixed(value + _mixed((row + 1).astype(np.uint64) * np.uint64(_BASES[0])))

    def has(self, row: np.ndarray, value: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(row), bool)
        key = self._key(row, value >> self.shift)
        return self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key


class Sorted:
    """Rows of a pass that a task holds: digits, doc_id, row key. Equal digits go out as rows that ask and rows that are
    answered, which have their row key as salt."""

    def __init__(self, n_digits: int, ends: bool) -> None:
        """ends: whether the last row of a group asks as well as the first one's document."""
        self.n, self.ends, self.held, self.size = n_digits, ends, [], 0
        self.schema = pa.schema([*[(f"d{k}", pa.int64()) for k in range(n_digits)], ("id", pa.int64()), ("row_key", pa.int64()), ("salt", pa.int64())])

    def add(self, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        columns = [np.concatenate(c) for c in zip(*self.held, strict=True)]
        self.held, self.size = [], 0
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        change = lambda cs: np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in cs])))
        fresh = change(columns)
        columns = [c[fresh] for c in columns]
        group = change(columns[: self.n])
        first = np.maximum.accumulate(np.where(group, np.arange(len(group)), 0))
        doc = columns[self.n]
        answered = doc > doc[first]
        if self.ends:
            answered = ~group & ~np.concatenate((group[1:], [True]))
        salt = pa.array(columns[self.n + 1], mask=~answered)
        yield pa.record_batch([*map(pa.array, columns), salt], schema=self.schema)


def _texts(docs: DataFrame, threshold: int) -> DataFrame:
    """(row_key, id, text) of rows that can hold a repeated window or repeat one."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text.cast("binary").alias("text"))
    return rows.filter(F.col("id").isNotNull() & (F.octet_length("text") >= threshold)).select(_row_key().alias("row_key"), "id", "text")


def _row_key():
    """The identifier and 16 bits of the text, so that rows that share an identifier don't share a list. It has few bytes
    for what compresses a shuffle; an identifier too large for that is hashed."""
    small = F.shiftleft("id", 16).bitwiseOR(F.xxhash64("text").bitwiseAND(0xFFFF))
    return F.when(F.col("id").between(0, (1 << 46) - 1), small).otherwise(F.xxhash64("id", "text"))


def _pass(rows: DataFrame, n_digits: int, threshold: int, choose, ends: bool = False) -> DataFrame:
    """rows (row_key, id, text, lists) as rows of a pass; choose gives digits and the row of each, from runs and lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sorted(n_digits, ends)
        for batch in batches:
            key, doc, texts = np.asarray(batch.column(0)), np.asarray(batch.column(1)), batch.column(2)
            lists = [Asked(c) for c in batch.columns[3:]]
            for runs in runs_of(texts, threshold):
                digits, row = choose(runs, *lists)
                yield from held.add([*[d.view(np.int64) for d in digits], doc[row], key[row]])
        yield from held.flush()

    return rows.mapInArrow(run, ", ".join([*[f"d{k} long" for k in range(n_digits)], "id long", "row_key long", "salt long"]))


def _first_digit(runs: Runs):
    return [runs.digit], runs.row


def _second_digit(runs: Runs, grams: Asked):
    which = np.flatnonzero(grams.has(runs.row, runs.digit))
    return [runs.digit[which], *runs.stretches(which, 2)], runs.row[which]


def _left(runs: Runs, stretches: Asked) -> np.ndarray:
    every = np.arange(len(runs.first))
    return every[stretches.has(runs.row, runs.stretches(every, 1)[0])]


def _third_digit(runs: Runs, stretches: Asked):
    run, _, _, common = runs.shares(_left(runs, stretches))
    return [common], runs.row[run]


def _last_digit(runs: Runs, stretches: Asked, shares: Asked):
    run, first, end, common = runs.shares(_left(runs, stretches))
    left = shares.has(runs.row[run], common)
    start = _counted(first[left], end[left])
    return [p.at(start, runs.threshold) for p in runs.prints(2)], runs.place(start)[0]


def _smallest(rows: DataFrame, n_digits: int) -> DataFrame:
    """Adds whether a document with a smaller identifier has the same digits."""
    group = W.partitionBy(*[f"d{k}" for k in range(n_digits)], "salt")
    return rows.withColumn("lost", F.col("salt").isNotNull() | (F.col("id") > F.min("id").over(group)))


def _asking(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(row_key, name): upper halves of the values that each row is asked about; a list is no longer than its row's text."""
    return rows.groupBy("row_key").agg(F.collect_list(F.shiftright(value, 32).cast("int")).alias(name))


def repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row of docs (doc_id, text): what repeats, as byte ranges, and what is left.

    A byte goes if a window of `threshold` bytes covers it that also starts in a row with a smaller doc_id. Windows are
    those of the input and never cross rows. Null text: empty. A row without doc_id, and rows that share one, take
    nothing from each other: a null is neither smaller nor larger. Rows that repeat give rows that repeat. Empty table:
    no rows. Other columns are ignored. Ranges are maximal and in order; kept is binary, as a cut may split a character.
    """
    tune(docs.sparkSession)
    texts = _texts(docs, threshold)
    grams = written(_again(_pass(texts, 1, threshold, _first_digit, ends=True), "grams"))
    judged = written(_judged_stretches(_pass(texts.join(grams, "row_key"), 3, threshold, _second_digit)))
    left = written(_stretches_left(judged))
    shares = written(_again(_pass(texts.join(left, "row_key"), 1, threshold, _third_digit, ends=True), "shares"))
    last = _pass(texts.join(left.join(shares, "row_key"), "row_key"), 2, threshold, _last_digit)
    windows = written(_smallest(last, 2).filter("lost").select("row_key", F.col("d0").alias("window")))
    gone = judged.filter("lost").select("row_key", F.col("d1").alias("stretch"), F.lit(None).cast("long").alias("window"))
    gone = gone.unionByName(windows.select("row_key", F.lit(None).cast("long").alias("stretch"), "window"))
    gone = gone.groupBy("row_key").agg(F.collect_list("stretch").alias("stretches"), F.collect_list("window").alias("windows")).join(left, "row_key", "left")
    every = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")).withColumn("row_key", _row_key())
    lists = [F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c) for c, kind in (("stretches", "long"), ("windows", "long"), ("left", "int"))]
    return _without(every.join(gone, "row_key", "left").select("id", "text", *lists), threshold)


def _again(rows: DataFrame, name: str) -> DataFrame:
    """(row_key, name): the digits of each row that another row has as well."""
    group = W.partitionBy("d0", "salt")
    again = rows.withColumn("again", F.col("salt").isNotNull() | (F.min("row_key").over(group) < F.max("row_key").over(group)))
    return _asking(again.filter("again"), "d0", name)


def _judged_stretches(rows: DataFrame) -> DataFrame:
    """(row_key, d0, d1, lost): stretches of runs with such digits; d0, the first digit, only where they aren't lost."""
    return _smallest(rows, 3).select("row_key", F.when(~F.col("lost"), F.col("d0")).alias("d0"), "d1", "lost")


def _stretches_left(judged: DataFrame) -> DataFrame:
    """(row_key, left): of the runs left, the stretches of those whose first digit has stretches of several rows."""
    firsts = judged.filter("not lost")
    mixed = firsts.groupBy("d0").agg(F.min("row_key").alias("low"), F.max("row_key").alias("high")).filter("low < high").select("d0")
    return _asking(firsts.join(mixed, "d0"), "d1", "left")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", SPANS), ("kept", pa.binary())])


def _without(rows: DataFrame, threshold: int) -> DataFrame:
    """rows (id, text, stretches, windows, left) with what they name taken out; windows are looked for in what was left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, stretches, windows, left = batch.column(1), *map(Asked, batch.columns[2:])
            at: dict[int, list[np.ndarray]] = {}
            for runs in runs_of(texts, threshold, stretches.rows | windows.rows):
                every = np.arange(len(runs.first))
                own = runs.stretches(every, 1)[0]
                lost = stretches.has(runs.row, own)
                start = runs.windows(every[~lost & windows.rows[runs.row] & left.has(runs.row, own)])
                row = runs.place(start)[0]
                start = np.concatenate((runs.windows(every[lost]), start[windows.has(row, runs.prints(1)[0].at(start, threshold))]))
                row, place = runs.place(np.sort(start))
                for r, own in zip(*_by_row(row, place), strict=True):
                    at.setdefault(int(r), []).append(own)
            out = []
            for row, (doc_id, text) in enumerate(zip(batch.column(0), texts, strict=True)):
                whole = memoryview(text.as_buffer())
                spans = spans_of(np.concatenate(at[row]), threshold) if row in at else []
                cuts = [0, *[x for s in spans for x in s], len(whole)]
                kept = b"".join(whole[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                out.append((doc_id.as_py(), len(whole), [{"start": a, "end": b} for a, b in spans], kept))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), OUT.types, strict=True)], schema=OUT)

    return rows.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def _by_row(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of each row; both are sorted."""
    edges = np.flatnonzero(np.diff(row, prepend=-1))
    return row[edges], np.split(place, edges[1:]) if len(edges) else []


def spans_of(starts: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Maximal ranges that windows with these starts, in order, cover."""
    edges = np.flatnonzero(np.diff(starts) > threshold)
    low, high = np.concatenate(([0], edges + 1)), np.concatenate((edges, [len(starts) - 1]))
    return list(zip(starts[low].tolist(), (starts[high] + threshold).tolist(), strict=True))


def digests(spans: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of what repeats() gives."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda x, s: x + s["end"] - s["start"])
    return spans.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
