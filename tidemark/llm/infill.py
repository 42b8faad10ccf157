"""Fill-in-the-middle examples, cut at code points by succinct rank and select.

A batch's texts lie end to end as UTF-8. One bit a byte says whether a code point starts there; the bits are packed into
64-bit words, and a directory holds how many stand before each block of eight words. The number of code points of a row
is a difference of two ranks, and a cut after k code points is the place that select finds for the row's first rank plus
k: neither walks the text, and no string of code points is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tune

#: Marks before the prefix, the suffix and the middle. A text that has one stays plain.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 texts, so many stay plain from this draw on, and so many of the others have the suffix first.
PLAIN_FROM, SUFFIX_FIRST = 90, 20
SEED = "1:"

WORD, WORDS = 64, 8
BLOCK = WORD * WORDS
#: Bytes turned into bits at a time, a multiple of BLOCK.
STEP = 1 << 20
#: A batch of results is passed on when it has so many bytes.
OUT_BYTES = 4 << 20

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


class Boundaries:
    """The starts of code points in UTF-8 bytes, as packed bits with a directory of counts."""

    def __init__(self, data: np.ndarray) -> None:
        self.size = len(data)
        packed = np.zeros(-(-(self.size + 1) // BLOCK) * BLOCK // 8, np.uint8)
        for at in range(0, self.size, STEP):
            bits = np.packbits((data[at : at + STEP] & 0xC0) != 0x80, bitorder="little")
            packed[at // 8 : at // 8 + len(bits)] = bits
        self.words = packed.view("<u8").reshape(-1, WORDS)
        self.counts = np.bitwise_count(self.words)
        self.before = np.concatenate(([0], np.cumsum(self.counts.sum(axis=1, dtype=np.int64))))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many code points start before each byte."""
        block, word, bit = at // BLOCK, at % BLOCK // WORD, at % WORD
        whole = np.where(np.arange(WORDS) < word[:, None], self.counts[block], 0).sum(axis=1, dtype=np.int64)
        part = np.bitwise_count(self.words[block, word] & ((np.uint64(1) << bit.astype(np.uint64)) - np.uint64(1)))
        return self.before[block] + whole + part

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Where the code point with so many before it starts; the end of the data for one more than there are."""
        out = np.full(len(nth), self.size, np.int64)
        there = np.flatnonzero(nth < self.before[-1])
        block = np.searchsorted(self.before, nth[there], "right") - 1
        left = nth[there] - self.before[block]
        upto = np.cumsum(self.counts[block], axis=1, dtype=np.int64)
        word = (upto <= left[:, None]).sum(axis=1)
        left -= np.where(word > 0, np.take_along_axis(upto, np.maximum(word - 1, 0)[:, None], 1)[:, 0], 0)
        bits = np.unpackbits(self.words[block, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out[there] = block * BLOCK + word * WORD + (np.cumsum(bits, axis=1) <= left[:, None]).sum(axis=1)
        return out


def _draws(doc_id: Column) -> list[Column]:
    """Four unsigned 32-bit draws of a document: the first groups of eight hex digits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * n + 1, 8), 16, 10).cast("long").alias(f"h{n + 1}") for n in range(4)]


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """Each row's text as an example of the form plain, psm or spm: (doc_id, n, form, prefix_chars, middle_chars, output).

    docs has doc_id and text; other columns are ignored. A null text is an empty one, and that is plain. A null doc_id
    draws like an empty one; rows that repeat give rows that repeat. Empty table: no rows. A batch's texts and one row's
    output are in memory at a time, with one bit a byte besides.
    """
    tune(docs.sparkSession)
    p, s, m = (x.encode() for x in MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            h = [np.asarray(batch.column(2 + n)) for n in range(4)]
            marks = Boundaries(data)
            first = marks.rank(offsets)
            n = np.diff(first)
            one, two = h[0] % (n + 1), h[1] % (n + 1)
            low, high = np.minimum(one, two), np.maximum(one, two)
            # the last row's end is the end of the data, every other row's is the start of the next one's first code point
            cuts = [np.minimum(marks.select(first[:-1] + k), offsets[1:]) for k in (low, high)]
            whole, out, size = memoryview(data), [], 0
            for k, doc_id in enumerate(batch.column(0)):
                text = bytes(whole[offsets[k] : offsets[k + 1]])
                if not text or h[2][k] % 100 >= PLAIN_FROM or p in text or s in text or m in text:
                    row = ("plain", None, None, text)
                else:
                    a, b = int(cuts[0][k] - offsets[k]), int(cuts[1][k] - offsets[k])
                    parts = (s, text[b:], p, text[:a]) if h[3][k] % 100 < SUFFIX_FIRST else (p, text[:a], s, text[b:])
                    row = ("spm" if parts[0] is s else "psm", int(low[k]), int(high[k] - low[k]), b"".join([*parts, m, text[a:b]]))
                out.append((doc_id.as_py(), int(n[k]), *row))
                size += len(row[-1])
                if size >= OUT_BYTES:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), ARROW.types, strict=True)], schema=ARROW)
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), ARROW.types, strict=True)], schema=ARROW)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *_draws(F.col("doc_id"))).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an example was made of, from its output and form alone; null for a null."""
    p, s, m = (F.lit(x) for x in MARKS)
    first, second = F.when(form == "psm", s).otherwise(p), F.when(form == "psm", p).otherwise(s)
    body = F.substr(output, F.length(second) + 1)
    head, rest = F.split_part(body, first, F.lit(1)), F.split_part(body, first, F.lit(2))
    tail, middle = F.split_part(rest, m, F.lit(1)), F.split_part(rest, m, F.lit(2))
    return F.when(form == "plain", output).when(form == "psm", F.concat(head, middle, tail)).otherwise(F.concat(tail, middle, head))


def digests(examples: DataFrame) -> DataFrame:
    """examples with SHA-256 of each output and of the text restored from it, instead of the output."""
    back = restored(F.col("output"), F.col("form"))
    return examples.withColumns({"output_sha256": F.sha2(F.col("output").cast("binary"), 256), "restored_sha256": F.sha2(back.cast("binary"), 256)}).drop("output")
