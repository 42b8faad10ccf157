"""Benchmark decontamination: random-walk embedding, bit sampling over item-sized windows, exact edit distance.

A text and an item are sequences of words. A walk over a window (as Chakraborty, Goldenberg and Koucky describe it) takes
one step or none for each of a sequence of random bits of the word it stands on, so that two sequences within few edits
are at the same words at most times: edit distance becomes Hamming distance. A repeat of the LSH compares what walk and
item read at SAMPLED times of one walk; a window is a candidate if any of its repeats agrees wholly, and their number
grows with the item's size, so that a leak at the allowed edits is found with a chance of TARGET. Longer items are cut
into parts, as one of them at least has no more than its share of the edits. Candidates are verified by the exact edit
distance of the whole item.

Windows are not taken everywhere: within k edits of an item of n words, a passage has at least n + 1 - q * (k + 1) of the
item's word q-grams (the q-gram lemma), on diagonals that differ by at most k. Where a text has fewer there is no leak,
so nothing is lost by that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import gathered, tune

#: A passage is a leak if 1 - edit distance / item's words is at least this.
SIMILARITY = 0.75
#: Benchmark items are broadcast in blocks of at most so many bytes; each block is held against all documents.
BLOCK_BYTES = 16 << 20
Q = 3
#: Bytes of text that are held against the items at once, about.
GATHERED = 4 << 20
#: Words of an item's parts, about: an item has as many as its words come to, rounded; up to one and a half, it is one part.
PART_WORDS = 32
#: Times of a walk that a repeat compares.
SAMPLED = 3
#: The chance with which a leak at the allowed edits becomes a candidate, whatever kind its edits are; measured in the tests.
TARGET = 0.999
#: Repeats that are tried on all windows; the others follow where none of them agreed.
FIRST_REPEATS = 12
#: Cells of one row of the edit-distance tables that are filled at once.
CELLS = 1 << 18


def _last_row(item: np.ndarray, text: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The last row of the edit-distance table of item against text, from its first row."""
    steps = np.arange(len(text) + 1)
    for word in item:
        now = np.minimum(row + 1, np.concatenate([row[:1] + 1, row[:-1] + (text != word)]))
        row = np.minimum.accumulate(now - steps) + steps
    return row


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of the item to any passage of the text, and where that passage begins and ends."""
    row = _last_row(item, text, np.zeros(len(text) + 1, np.int64))
    end = int(row.argmin())
    back = _last_row(item[::-1], text[:end][::-1], np.arange(end + 1))
    return int(row[end]), end - int(back.argmin()), end


@dataclass
class Items:
    """A block of benchmark items, ready to be held against documents.

    sizes and edits are of items; item, offset, length, part_edits, need and start of their parts, where start is the
    part's place in flat, all items' words one after the other. grams: for each q the codes (sorted), part and place.
    """

    ids: list[int | None]
    words: list[np.ndarray]
    vocabulary: dict[bytes, int]
    sizes: np.ndarray
    edits: np.ndarray
    flat: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    start: np.ndarray
    length: np.ndarray
    part_edits: np.ndarray
    need: np.ndarray
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _codes(words: np.ndarray, q: int, base: int) -> np.ndarray:
    """A number for each q-gram of words; 0 if one of the words is unknown."""
    n = len(words) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(q):
        part = words[k : k + n]
        code = code * np.uint64(base) + part
        known &= part > 0
    return np.where(known, code, np.uint64(0))


def prepare(rows: list[tuple[int | None, bytes]]) -> Items:
    vocabulary: dict[bytes, int] = {}
    ids, words = [], []
    for item_id, text in rows:
        found = text.lower().split()
        if found:
            ids.append(item_id)
            words.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in found], np.uint64))
    base = len(vocabulary) + 1
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
    n_parts = np.maximum(1, (sizes + PART_WORDS // 2) // PART_WORDS)
    item = np.repeat(np.arange(len(words)), n_parts)
    number = np.arange(len(item)) - np.repeat(np.cumsum(n_parts) - n_parts, n_parts)
    offset = number * sizes[item] // n_parts[item]
    length = (number + 1) * sizes[item] // n_parts[item] - offset
    start = (np.cumsum(sizes) - sizes)[item] + offset
    edits = allowed(length)
    q_of = np.maximum(1, np.minimum(Q, length // (edits + 1)))
    grams = {}
    for q in np.unique(q_of).tolist():
        parts = np.flatnonzero(q_of == q)
        n = length[parts] - q + 1
        owner = np.repeat(parts, n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        codes = _codes(flat, q, base)[start[owner] + place]
        order = np.argsort(codes, kind="stable")
        grams[q] = codes[order], owner[order], place[order]
    need = np.maximum(1, length + 1 - q_of * (edits + 1))
    return Items(ids, words, vocabulary, sizes, allowed(sizes), flat, item, offset, start, length, edits, need, grams)


def allowed(size: np.ndarray) -> np.ndarray:
    """Edits of a leak of an item of so many words at most."""
    return np.floor(size * (1 - SIMILARITY) + 1e-9).astype(np.int64)


def _matches(table: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of asked (by index) equal which rows of a sorted table, as pairs."""
    low, high = np.searchsorted(table, asked), np.searchsorted(table, asked, "right")
    n = high - low
    where = np.repeat(np.arange(len(asked)), n)
    return where, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def places_of(items: Items, words: np.ndarray, first: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, low, high) of all places that pass the q-gram test, in texts that follow each other with a 0 between.

    first, ends: for each place in words, where its text begins and ends. A place holds every passage within the part's
    edits that has a q-gram on its diagonals; places of a part that overlap are one.
    """
    out = []
    base = len(items.vocabulary) + 1
    for q, (codes, owner, place) in items.grams.items():
        found = _codes(words, q, base)
        at = np.flatnonzero(found)
        near = np.minimum(np.searchsorted(codes, found[at]), len(codes) - 1)
        at = at[codes[near] == found[at]]
        if not len(at):
            continue
        hit, row = _matches(codes, found[at])
        item, diagonal, begin, end = owner[row], at[hit] - place[row], first[at[hit]], ends[at[hit]]  # item: a part's number
        order = np.lexsort((diagonal, item))
        item, diagonal, begin, end = item[order], diagonal[order], begin[order], end[order]
        # votes for the same item within its edits on either side of a diagonal
        span = len(words) + 4 * int(items.length.max())
        line = item * (2 * span) + diagonal + span // 2
        k = items.part_edits[item]
        votes = np.searchsorted(line, line + k, "right") - np.searchsorted(line, line - k)
        good = votes >= items.need[item]
        item, diagonal, begin, end, k = item[good], diagonal[good], begin[good], end[good], k[good]
        order = np.lexsort((diagonal, begin, item))
        item, diagonal, begin, end, k = item[order], diagonal[order], begin[order], end[order], k[order]
        low, high = np.maximum(diagonal - k, begin), np.minimum(diagonal + items.length[item] + k, end)
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (begin[1:] != begin[:-1]) | (low[1:] > high[:-1])
        heads = np.flatnonzero(new)
        out.append((item[heads], low[heads], high[np.append(heads[1:], len(item))[: len(heads)] - 1]))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none, none)


def repeats_of(length: np.ndarray) -> np.ndarray:
    """Repeats that reach TARGET at the allowed edits of so many words; the rule was found by measuring."""
    return np.where(allowed(length) == 0, 1, 6 * length)


_RANDOM = np.random.default_rng(20240501)
_STEPS = _RANDOM.integers(0, 1 << 63, 4 * PART_WORDS, dtype=np.uint64)
_WALKS = _RANDOM.integers(0, 1 << 63, 9 * PART_WORDS, dtype=np.uint64) | np.uint64(1)
_TIMES = _RANDOM.random((SAMPLED, 9 * PART_WORDS))
_END = np.uint64((1 << 64) - 1)


def embedded(words: np.ndarray, start: np.ndarray, length: np.ndarray, ends: np.ndarray, first: int, last: int) -> np.ndarray:
    """For each window and each of the repeats first to last - 1, a hash of what its walk reads at the sampled times.

    A window is length words from start on, and nothing from ends on. Times are within twice its length, as a walk
    takes a step every second time.
    """
    walks = _WALKS[None, first:last]
    times = [(t[None, first:last] * (2 * length[:, None])).astype(np.int64) for t in _TIMES]
    room = np.minimum(length, ends - start)[:, None]
    at = np.zeros((len(start), last - first), np.int64)
    out = np.zeros(at.shape, np.uint64)
    for step in range(2 * int(length.max(initial=0))):
        word = np.where(at < room, words[np.minimum(start[:, None] + at, len(words) - 1)], _END)
        read = (times[0] == step) | (times[1] == step) | (times[2] == step)
        out = np.where(read, (out ^ word) * np.uint64(0x9E3779B97F4A7C15) + (out >> np.uint64(31)), out)
        at += ((word + _STEPS[step]) * walks >> np.uint64(63)).astype(np.int64)
    return out


def sampled_alike(items: Items, words: np.ndarray, ends: np.ndarray, part: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which places (by index) have a window that agrees with their part in one repeat."""
    found = []
    # windows of so many places at a time that what is held stays in the bound
    n_windows = np.maximum(1, high - low - items.length[part] + items.part_edits[part] + 1)
    repeats = repeats_of(items.length[part])
    for some in np.split(np.arange(len(part)), np.flatnonzero(np.diff(np.cumsum(n_windows * FIRST_REPEATS) // CELLS)) + 1):
        first = 0
        while len(some):
            last = FIRST_REPEATS if not first else min(int(repeats[some].max()), first + max(1, CELLS // int(n_windows[some].sum())))
            of = np.repeat(np.arange(len(some)), n_windows[some])
            start = low[some][of] + np.arange(len(of)) - np.repeat(np.cumsum(n_windows[some]) - n_windows[some], n_windows[some])
            length = items.length[part[some]]
            own = embedded(items.flat, items.start[part[some]], length, items.start[part[some]] + length, first, last)
            seen = embedded(words, start, length[of], ends[low[some]][of], first, last)
            hit = np.zeros(len(some), bool)
            hit[of[(seen == own[of]).any(axis=1)]] = True
            found.append(some[hit])
            first = last
            some = some[~hit & (repeats[some] > first)]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def whole_places(items: Items, first: np.ndarray, ends: np.ndarray, part: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, low, high): where the whole items of these places of parts can lie; those of an item that overlap are one."""
    item, begin, end = items.item[part], first[low], ends[low]
    before, after = items.offset[part], items.sizes[item] - items.offset[part] - items.length[part]
    k = np.where(before + after > 0, items.edits[item], 0)
    low, high = np.maximum(low - before - k, begin), np.minimum(high + after + k, end)
    order = np.lexsort((low, begin, item))
    item, begin, low, high = item[order], begin[order], low[order], high[order]
    heads, upto = [], []
    for n in range(len(item)):
        if heads and item[n] == item[heads[-1]] and begin[n] == begin[heads[-1]] and low[n] <= upto[-1]:
            upto[-1] = max(upto[-1], high[n])
        else:
            heads.append(n)
            upto.append(high[n])
    return item[heads], low[heads], np.array(upto, np.int64)


def close_enough(items: Items, words: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which places (by index) hold a passage within the edits of their item."""
    out = []
    sizes, lengths = items.sizes[item], high - low
    order = np.lexsort((lengths, sizes))
    at = 0
    while at < len(order):
        size = sizes[order[at]]
        same = int(np.searchsorted(sizes[order], size, "right"))
        # so many places of this size that the longest, times their number, stays in the bound
        widths = (lengths[order[at:same]] + 1) * np.arange(1, same - at + 1)
        some = order[at : at + max(1, int(np.searchsorted(widths, CELLS, "right")))]
        at += len(some)
        width = int(lengths[some].max())
        place = low[some][:, None] + np.arange(width)
        text = np.where(place < high[some][:, None], words[np.minimum(place, len(words) - 1)], np.uint64(0)).astype(np.int32)
        asked = np.stack([items.words[n] for n in item[some].tolist()]).astype(np.int32)
        steps = np.arange(width + 1, dtype=np.int32)
        row = np.zeros((len(some), width + 1), np.int32)
        for n in range(int(size)):
            now = row + 1
            np.minimum(now[:, 1:], row[:, :-1] + (text != asked[:, n : n + 1]), out=now[:, 1:])
            row = np.minimum.accumulate(now - steps, axis=1) + steps
        out.append(some[row.min(axis=1) <= items.edits[item[some]]])
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


def leaks_of(items: Items, texts: list[bytes]) -> list[tuple[int, int | None, int, int, int, float]]:
    """(text, item, first word, last word, edits, similarity) of the best passage for each item that leaks into a text."""
    found = [t.lower().split() for t in texts]
    lengths = np.array([len(f) for f in found], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    words = np.zeros(int(lengths.sum()) + len(found), np.uint64)
    get = items.vocabulary.get
    for f, at in zip(found, begins.tolist(), strict=True):
        words[at : at + len(f)] = [get(w, 0) for w in f]
    first, ends = np.repeat(begins, lengths + 1), np.repeat(begins + lengths, lengths + 1)
    part, lows, highs = places_of(items, words, first, ends)
    if not len(part):
        return []
    alike = sampled_alike(items, words, ends, part, lows, highs)
    item_of, lows, highs = whole_places(items, first, ends, part[alike], lows[alike], highs[alike])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for n in close_enough(items, words, item_of, lows, highs).tolist():
        item, low, high = int(item_of[n]), int(lows[n]), int(highs[n])
        begin = int(first[low])
        text = int(np.searchsorted(begins, low, "right")) - 1
        distance, low_word, high_word = edit_distance(items.words[item], words[low:high])
        if (text, item) not in best or distance < best[text, item][0]:
            best[text, item] = distance, low + low_word - begin, low + high_word - begin - 1
    return [(t, items.ids[i], s, e, d, 1 - d / len(items.words[i])) for (t, i), (d, s, e) in sorted(best.items())]


def _checked(texts: DataFrame, rows: list[tuple[int | None, bytes]], at: int) -> DataFrame:
    """texts without the rows whose text (column at) holds a leak of the items."""
    shared = texts.sparkSession.sparkContext.broadcast(prepare(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in gathered(batches, at, GATHERED):
            leaking = {n for n, *_ in leaks_of(items, [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(at)])} if items.ids else set()
            yield batch.filter(pa.array([n not in leaking for n in range(batch.num_rows)], pa.bool_())) if leaking else batch

    return texts.mapInArrow(run, texts.schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs (text, and any other columns) that hold no passage of an item of benchmark (item_id, text).

    Each row is judged by its own text, so identifiers may be null or repeat. Null and empty texts stay; null and empty
    items leak nothing. Blocks of items follow one another in one pass over the rows; nothing is joined or shuffled.
    """
    tune(docs.sparkSession)
    for rows in _blocks_of(benchmark):
        docs = _checked(docs, rows, docs.columns.index("text"))
    return docs


SCHEMA = "doc_id long, item_id long, first_word long, last_word long, edits long, similarity double"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64()), ("similarity", pa.float64())]
)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each document's best passage for each benchmark item that leaks into it.

    docs has doc_id and text, benchmark item_id and text; other columns are ignored. Texts are A-Z-lowered and split at
    white space. Null and empty texts on either side leak nothing, an empty table on either side gives no rows. Rows
    that repeat, on either side, give rows that repeat; null identifiers are passed on. A benchmark beyond BLOCK_BYTES is
    taken in blocks, each against all documents.
    """
    tune(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    out = None
    for rows in _blocks_of(benchmark):
        found = _against(texts, rows)
        out = found if out is None else out.unionByName(found)
    return out


def _blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items (identifier, text) in blocks of about BLOCK_BYTES, one at least; only one is on the driver at a time."""
    given = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    for n in range(n_blocks):
        block = given.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == n) if n_blocks > 1 else given
        yield [(r.item_id, bytes(r.text)) for r in block.orderBy("item_id", "text").collect()]


def _against(texts: DataFrame, rows: list[tuple[int | None, bytes]]) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(prepare(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in gathered(batches, 1, GATHERED):
            if not items.ids:
                continue
            ids = batch.column(0).to_pylist()
            found = leaks_of(items, [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)])
            if found:
                columns = zip(*[(ids[n], *x) for n, *x in found], strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, ARROW.types, strict=True)], schema=ARROW)

    return texts.mapInArrow(run, SCHEMA)
