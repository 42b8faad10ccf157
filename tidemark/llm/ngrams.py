"""Language-model scoring by deleted interpolation.

The probability of a token after another mixes the maximum-likelihood estimates of orders two, one and zero. The weights
of the mixture depend on how often the context was seen (a bucket a power of two), and are learned by expectation
maximisation on the held-out part of the training documents, with counts from the rest of them; scores then use the
counts of all training documents.

Text is read once: blocks of tokenised documents are stored as word hashes and indices. A block asks for the counts of
each word and pair that it has once, however often they occur, so a frequent pair is one item a block; the counts are
summed in buckets of the hash, sent back to the blocks, and applied there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, stored, tune

#: Tokens from which a block is closed; one document of any length is in one block.
BLOCK_TOKENS = 1_500_000
#: Items that a bucket of hashes has at most, on average.
BUCKET_ITEMS = 3_000_000
#: Kinds of documents: counted at once, counted after the weights are learned on them, scored only.
COUNTED, HELD_OUT, SCORED = 0, 1, 2
#: Buckets of context frequency: 0 for an unseen context, then powers of two.
CONTEXTS = 18
#: For expectation maximisation, logarithms to base 2 are taken in steps of 1 / FINE.
FINE = 8
EM_ROUNDS = 60
END = b""


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _press(a: np.ndarray) -> bytes:
    """Bytes of an array, first all first bytes and so on, compressed."""
    return zstandard.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes(), 1) if len(a) else b""


def _unpress(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _press_sorted(a: np.ndarray) -> bytes:
    return _press(np.diff(a, prepend=np.zeros(1, np.uint64)))


def _unpress_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpress(data, np.uint64), dtype=np.uint64)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ordered pair of hashes."""
    h = first * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    h = (h ^ (h >> np.uint64(29)) ^ second) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BLOCK_SCHEMA = "block long, kind int, doc_ids array<long>, lengths array<int>, n_tokens long, words binary, tokens binary"
BLOCKS = pa.schema(
    [("block", pa.int64()), ("kind", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("words", pa.binary()), ("tokens", pa.binary())]
)


class _Block:
    def __init__(self) -> None:
        self.numbers, self.ids, self.lengths, self.tokens, self.size = _Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = text.lower().split()
        words.append(END)
        self.tokens.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.size += len(words)

    def close(self, block: int, kind: int) -> pa.RecordBatch:
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.numbers), np.uint64, len(self.numbers))
        words, place = np.unique(hashes, return_inverse=True)
        tokens = place.astype(np.uint32)[np.concatenate(self.tokens)]
        row = [block], [kind], [self.ids], [self.lengths], [self.size], [_press_sorted(words)], [_press(tokens)]
        self.__init__()
        return pa.record_batch([pa.array(c, t) for c, t in zip(row, BLOCKS.types, strict=True)], schema=BLOCKS)


def blocks_of(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, kind) as blocks of one kind each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number = TaskContext.get().partitionId() << 24, 0
        held = [_Block(), _Block(), _Block()]
        for batch in batches:
            for doc_id, text, kind in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                held[kind].add(doc_id, text.as_buffer().to_pybytes() if text.is_valid else b"")
                if held[kind].size >= BLOCK_TOKENS:
                    yield held[kind].close(first + number, kind)
                    number += 1
        for kind, block in enumerate(held):
            if block.size:
                yield block.close(first + number, kind)
                number += 1

    return docs.mapInArrow(run, BLOCK_SCHEMA)


def _expand(words: bytes, tokens: bytes, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, each token's word and the word before it, each token's pair, and the pairs' hashes (sorted)."""
    w, t = _unpress_sorted(words), _unpress(tokens, np.uint32).astype(np.int64)
    before = np.empty_like(t)
    before[1:] = t[:-1]
    before[0] = t[-1]  # a document begins after an end, and the last token of a block is one
    pairs, pair_of = np.unique(pair_hashes(w[before], w[t]), return_inverse=True)
    return w, t, before, pair_of, pairs


REQUEST_SCHEMA = "bucket int, block long, kind int, words binary, word_counts binary, pairs binary, pair_counts binary"
REQUESTS = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("words", pa.binary()), ("word_counts", pa.binary()), ("pairs", pa.binary()), ("pair_counts", pa.binary())]
)
ANSWER_SCHEMA = "bucket int, block long, kind int, distinct long, words binary, held_words binary, pairs binary, held_pairs binary"
ANSWERS = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("distinct", pa.int64()), ("words", pa.binary()), ("held_words", pa.binary()), ("pairs", pa.binary()), ("held_pairs", pa.binary())]
)


def requests_of(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """What each block asks each bucket for: its distinct words and pairs there, with the block's counts of them."""
    edges = np.array([(b << 64) // n_buckets for b in range(1, n_buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                w, t, _, pair_of, pairs = _expand(r["words"], r["tokens"], r["lengths"])
                counts = r["kind"] != SCORED
                n_w, n_p = np.bincount(t, minlength=len(w)).astype(np.uint32), np.bincount(pair_of, minlength=len(pairs)).astype(np.uint32)
                cut_w, cut_p = [0, *np.searchsorted(w, edges).tolist(), len(w)], [0, *np.searchsorted(pairs, edges).tolist(), len(pairs)]
                rows = []
                for b in range(n_buckets):
                    (i, j), (k, m) = cut_w[b : b + 2], cut_p[b : b + 2]
                    if j > i or m > k:
                        rows.append((b, r["block"], r["kind"], _press_sorted(w[i:j]), _press(n_w[i:j]) if counts else b"", _press_sorted(pairs[k:m]), _press(n_p[k:m]) if counts else b""))
                yield pa.record_batch([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), REQUESTS.types, strict=True)], schema=REQUESTS)

    return blocks.mapInArrow(run, REQUEST_SCHEMA)


def _sum_up(kinds: list[int], items: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """All counted items (sorted) with their counts of either kind, and each block's own items."""
    own = [_unpress_sorted(x) for x in items]
    sums = []
    seen = [o for o, k in zip(own, kinds, strict=True) if k != SCORED]
    keys = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
    for kind in (COUNTED, HELD_OUT):
        total = np.zeros(len(keys), np.int64)
        for o, c, k in zip(own, counts, kinds, strict=True):
            if k == kind:
                total[np.searchsorted(keys, o)] += _unpress(c, np.uint32)  # a block has each item once
        sums.append(total)
    return keys, sums[0], sums[1], own


def _look_up(keys: np.ndarray, sums: np.ndarray, items: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(items), np.int64)
    at = np.minimum(np.searchsorted(keys, items), len(keys) - 1)
    return np.where(keys[at] == items, sums[at], 0)


def answers_of(requests: DataFrame) -> DataFrame:
    """Counts over all training documents for what each block asked, in the block's order."""

    def run(group: pa.Table) -> pa.Table:
        r = group.to_pydict()
        words = _sum_up(r["kind"], r["words"], r["word_counts"])
        pairs = _sum_up(r["kind"], r["pairs"], r["pair_counts"])
        rows = []
        for n, block in enumerate(r["block"]):
            found = [_press(_look_up(k[0], k[s], k[3][n]).astype(np.uint64)) for k in (words, pairs) for s in (1, 2)]
            rows.append((r["bucket"][n], block, r["kind"][n], len(words[0]) if n == 0 else 0, *found))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ANSWERS.types, strict=True)], schema=ANSWERS)

    return requests.groupBy("bucket").applyInArrow(run, ANSWER_SCHEMA)


def _known(block: dict, answers: dict) -> tuple[np.ndarray, ...]:
    """Per token: counts of its word, of the word before it and of the pair, without and of the held-out part."""
    _, t, before, pair_of, _ = _expand(block["words"][0], block["tokens"][0], block["lengths"][0])
    order = np.argsort(answers["bucket"])
    word, held_word, pair, held_pair = (np.concatenate([_unpress(answers[c][k], np.uint64) for k in order]).astype(np.int64) for c in ("words", "held_words", "pairs", "held_pairs"))
    return word[t], held_word[t], word[before], held_word[before], pair[pair_of], held_pair[pair_of]


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(count + 1)), CONTEXTS - 1).astype(np.int64)


def _step(p: np.ndarray) -> np.ndarray:
    """The logarithm in steps of 1 / FINE, 1 for a probability of 0."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.round(np.log2(np.where(p > 0, p, 1)) * FINE), 1).astype(np.int64)


def learn_weights(histogram: list[tuple[int, int, int, int]], uniform: float) -> np.ndarray:
    """Weights of orders 2, 1, 0 for each context bucket, from (bucket, step of p2, step of p1, tokens).

    A bucket without held-out tokens has the weights of all buckets together; without any, equal weights.
    """
    h = np.array(histogram, np.float64).reshape(-1, 4)
    p = np.stack([np.where(h[:, c] > 0, 0.0, 2.0 ** (h[:, c] / FINE)) for c in (1, 2)] + [np.full(len(h), uniform)], 1)

    def em(p: np.ndarray, n: np.ndarray, start: np.ndarray) -> np.ndarray:
        w = start
        for _ in range(EM_ROUNDS):
            mix = p * w
            w = (mix / mix.sum(1, keepdims=True) * n[:, None]).sum(0) / n.sum()
        return w

    every = np.full(3, 1 / 3)
    if len(h):
        every = em(p, h[:, 3], every)
    out = np.tile(every, (CONTEXTS, 1))
    for b in range(CONTEXTS):
        rows = h[:, 0] == b
        if rows.any():
            out[b] = em(p[rows], h[rows, 3], np.full(3, 1 / 3))
    # the uniform part never vanishes, so no token has probability 0
    out = np.maximum(out, [0.0, 0.0, 1e-6])
    return out / out.sum(1, keepdims=True)


HISTOGRAM = pa.schema([("bucket", pa.int64()), ("p2", pa.int64()), ("p1", pa.int64()), ("n", pa.int64())])
SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SCORES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def score(docs: DataFrame) -> DataFrame:
    """The model's log10 probability of each row's text, and that of a smoothed unigram model, for docs (doc_id, text).

    Words are runs of anything but white space in the A-Z-lowered text; an end follows the last one and counts as a
    token. Training rows: CRC-32 of doc_id as text, mod 7, isn't 2; those with 3 are held out for the weights. Null text
    counts as empty: the end alone. A null doc_id counts as an empty one for the split. Rows that repeat are counted and
    scored each; other columns are ignored. Without training rows all probabilities are uniform.
    """
    spark = docs.sparkSession
    tune(spark)
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7))
    kind = F.when(part == 2, SCORED).when(part == 3, HELD_OUT).otherwise(COUNTED)
    blocks = stored(blocks_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"), kind.cast("int").alias("kind"))))
    totals = {r.kind: r.n for r in blocks.groupBy("kind").agg(F.sum("n_tokens").alias("n")).collect()}
    counted, train = totals.get(COUNTED, 0), totals.get(COUNTED, 0) + totals.get(HELD_OUT, 0)
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(sum(totals.values()) / BUCKET_ITEMS))
    answers = stored(answers_of(requests_of(blocks, n_buckets)))
    release(spark)
    distinct = answers.agg(F.sum("distinct")).first()[0] or 0
    uniform = 1 / (distinct + 1)

    def histogram(block: pa.Table, answer: pa.Table) -> pa.Table:
        b = block.to_pydict()
        if not b["block"]:
            return HISTOGRAM.empty_table()
        word, _, context, _, pair, _ = _known(b, answer.to_pydict())
        p2, p1 = pair / np.maximum(context, 1), word / max(1, counted)
        cell = np.stack([context_bucket(context), _step(p2), _step(p1)], 1)
        cells, n = np.unique(cell, axis=0, return_counts=True)
        return pa.table([*(pa.array(cells[:, c]) for c in range(3)), pa.array(n)], schema=HISTOGRAM)

    held = blocks.filter(F.col("kind") == HELD_OUT)
    cells = held.groupBy("block").cogroup(answers.filter(F.col("kind") == HELD_OUT).groupBy("block")).applyInArrow(histogram, "bucket long, p2 long, p1 long, n long")
    # at most CONTEXTS times the square of FINE * 64 rows
    weights = learn_weights([tuple(r) for r in cells.groupBy("bucket", "p2", "p1").agg(F.sum("n").alias("n")).orderBy("bucket", "p2", "p1").collect()], uniform)

    def scores(block: pa.Table, answer: pa.Table) -> pa.Table:
        b = block.to_pydict()
        if not b["block"]:
            return SCORES.empty_table()
        word, held_word, context, held_context, pair, held_pair = _known(b, answer.to_pydict())
        word, context, pair = word + held_word, context + held_context, pair + held_pair
        w = weights[context_bucket(context)]
        p = w[:, 0] * (pair / np.maximum(context, 1)) + w[:, 1] * (word / max(1, train)) + w[:, 2] * uniform
        if not train:
            p = np.full(len(word), uniform)
        lengths = np.array(b["lengths"][0])
        starts = np.cumsum(lengths) - lengths
        base = np.add.reduceat(np.log10((word + 1) / (train + distinct + 1)), starts)
        known = np.add.reduceat((word > 0).astype(np.int64), starts)
        n = len(lengths)
        return pa.table(
            [pa.array(b["doc_ids"][0], pa.int64()), pa.array([b["kind"][0] == SCORED] * n), pa.array(lengths, pa.int64()), pa.array(known), pa.array([train] * n, pa.int64()),
             pa.array(base), pa.array(np.add.reduceat(np.log10(p), starts))], schema=SCORES)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scores, SCORE_SCHEMA)
