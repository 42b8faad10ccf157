"""Vector bin packing of training examples into sequences.

An example needs tokens, one segment, and loss-bearing tokens; a sequence has a limit for each. The dot-product
heuristic fills one sequence after the other: of the waiting examples that fit, the next is the one whose needs (as
shares of the limits) have the largest dot product with what is left. When none fits, the example that can fill most of
what is left is cut. The limit on loss-bearing tokens is a little under that on tokens: a sequence is full when tokens
without loss (titles, prompts) take the rest, and else it has that little padding at most. Waiting examples are held in a pool of bounded size; each task packs its own rows, so nothing is shuffled, and
only a task's last sequences can have much padding.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tidemark.llm.common import tune

#: Tokens, segments and loss-bearing tokens of a sequence at most.
LIMITS = (2048, 512, 2032)
#: The same for conversations, of which only the last answer bears loss.
INSTRUCTION_LIMITS = (2048, 64, 1536)
END_ID = 1
#: Waiting tokens from which sequences are filled, in sequences.
POOL = 128
#: Words remembered at most, about; of a full half, the older half goes.
CACHE = 600_000
#: Characters that are split into pieces at once; longer texts are taken in parts that end at a space.
PART = 6 << 20


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as it is, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes, just as the tokenizer file's own pipeline gives them.

    Where the file drops white space, lower-cases and splits into words, texts are cut at white space, and the different
    pieces of many texts are told apart by Arrow, so that each is looked at once however often it stands there. Words are
    remembered; those that are new go through the file's merges together. Pieces with characters beyond Latin letters go
    through the whole pipeline, as do all texts of other tokenizer files.
    """

    WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    PLAIN = re.compile("[\x21-\u024f]+")

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        norm, split = told["normalizer"] or {}, told["pre_tokenizer"] or {}
        kinds = [x["type"] for x in norm.get("normalizers", [])], [x["type"] for x in split.get("pretokenizers", [])]
        self.by_word = (
            kinds == (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])
            and split["pretokenizers"][0]["pattern"] == {"Regex": self.WORD}
            and told["model"].get("end_of_word_suffix") == "</w>"
            and told["post_processor"] is None
        )
        if not self.by_word:
            return
        # the same model, for words that are already cut and lower-cased
        self.words = Tokenizer(self.whole.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, n in self.whole.get_vocab().items():
            self.ends[n] = token.endswith("</w>")
        self.letters = _byte_letters() | {32: " "}
        self.pattern = regex.compile(self.WORD)
        # words by age: the younger half, and those that were young before it
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        """Give the memory of a task's words back: a worker process lives on and serves other operators."""
        if self.by_word:
            self.young, self.old = {}, {}
        gc.collect()
        pa.default_memory_pool().release_unused()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [np.asarray(x.ids, "<u4").tobytes() for x in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        out: list[list[bytes]] = [[] for _ in texts]
        some: list[tuple[int, str]] = []
        size = 0
        for n, text in enumerate(texts):
            for part in self.parts(text):
                some.append((n, part))
                size += len(part)
                if size >= PART:
                    self._into(out, some)
                    some, size = [], 0
        self._into(out, some)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _into(self, out: list[list[bytes]], some: list[tuple[int, str]]) -> None:
        for (n, _), ids in zip(some, self.of_parts([t for _, t in some]), strict=True):
            out[n].append(ids)

    def of_parts(self, texts: list[str]) -> list[bytes]:
        # the strings of special tokens count as they are written, so a text with one goes through the whole pipeline
        special = {n: self.of_whole(t) for n, t in enumerate(texts) if "<|" in t}
        lowered = pc.ascii_lower(pa.array([t if n not in special else "" for n, t in enumerate(texts)] if special else texts, pa.string()))
        # a mark after a letter and before white space is a word of its own
        apart = pc.replace_substring_regex(lowered, r"(\pL)([.,;:!?])([ \n]|$)", r"\1 \2\3")
        # only ASCII white space cuts; what else the tokenizer takes for white space stays in a piece that isn't plain
        cut = pc.ascii_split_whitespace(apart)
        del lowered, apart
        coded = cut.flatten().dictionary_encode()
        found = self.of_pieces(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        ids, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        which = coded.indices.to_numpy()
        each = sizes[which]
        ends = np.cumsum(each, dtype=np.int32)
        flat = ids[np.repeat(starts[which] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        cuts = np.concatenate([[0], ends])[cut.offsets.to_numpy()].tolist()
        return [special[n] if n in special else flat[i:j].tobytes() for n, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False))]

    def of_whole(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def parts(text: str) -> Iterator[str]:
        """Parts of at most PART characters that end at a space, or the whole rest if none is left to cut at."""
        start = 0
        while len(text) - start > PART:
            end = text.rfind(" ", start, start + PART)
            if end <= start:
                break
            yield text[start:end]
            start = end
        yield text[start:]

    def of_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of some different A-Z-lowered pieces without ASCII white space."""
        if len(self.young) > CACHE // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        if late := [p for p in pieces if p not in young]:
            if again := [p for p in late if p in old]:
                young.update({p: old[p] for p in again})
                late = [p for p in late if p not in old]
            self.remember(late)
        return list(map(young.__getitem__, pieces))

    def remember(self, late: list[str]) -> None:
        young = self.young
        words, rest = [], []
        for p in late:
            (words if p.isascii() and p.isalpha() else rest).append(p)
        plain = [p for p in rest if p.isprintable() and (p.isascii() or self.PLAIN.fullmatch(p))]
        split = [(x,) if x.isalpha() else self.pattern.findall(x) for x in unicodedata.normalize("NFC", " ".join(plain)).lower().split(" ")] if plain else []
        asked = set().union(*split)
        asked.update(words)
        young.update(self.learn([w for w in asked if w not in young]))
        young.update(zip(plain, [young[x[0]] if len(x) == 1 else b"".join([young[w] for w in x]) for x in split], strict=True))
        for p in rest:
            if p not in young:
                young[p] = self.of_whole(p)

    def learn(self, new: list[str]) -> Iterator[tuple[str, bytes]]:
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            joined = " ".join(some).encode().decode("latin-1").translate(self.letters)
            ids = np.asarray(self.words.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(cuts) != len(some):
                raise ValueError("the tokenizer didn't give each word an end")
            whole = ids.tobytes()
            yield from zip(some, [whole[i:j] for i, j in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True)


@cache
def ids_of(path: str) -> Ids:
    """One for each tokenizer file and worker process, as reading the file takes seconds."""
    return Ids(path)


class Packer:
    """Fills sequences from examples (key, tokens, loss-bearing tokens); an example bears its loss at its end.

    Gives (key, start, length, sequence, offset). Each token of an example lies in exactly one piece.
    """

    def __init__(self, limits: tuple[int, int, int] = LIMITS, pool: int = POOL) -> None:
        self.limits, self.high, self.low = limits, pool * limits[0], pool * limits[0] // 4
        self.keys: list[tuple] = []
        self.size = np.zeros(1024, np.int64)
        self.loss = np.zeros(1024, np.int64)
        self.n = self.held = self.sequence = 0

    def add(self, key: object, tokens: int, loss: int) -> Iterator[tuple]:
        start, quiet = 0, tokens - loss
        most = min(self.limits[0], self.limits[2])
        while tokens - start > most:
            self._put(key, start, most, max(0, start + most - max(quiet, start)))
            start += most
            if self.held >= self.high:
                yield from self._fill(self.low)
        if tokens > start:
            self._put(key, start, tokens - start, tokens - max(quiet, start))
        if self.held >= self.high:
            yield from self._fill(self.low)

    def _put(self, key: object, start: int, tokens: int, loss: int) -> None:
        if self.n == len(self.size):
            self.size, self.loss = np.resize(self.size, 2 * self.n), np.resize(self.loss, 2 * self.n)
        self.size[self.n], self.loss[self.n] = tokens, loss
        self.keys.append((key, start))
        self.n += 1
        self.held += tokens

    def _take(self, k: int) -> tuple:
        out = (*self.keys[k], int(self.size[k]), int(self.loss[k]))
        self.n -= 1
        self.held -= out[2]
        last = self.keys.pop()
        if k < self.n:
            self.keys[k], self.size[k], self.loss[k] = last, self.size[self.n], self.loss[self.n]
        return out

    def _fill(self, down_to: int) -> Iterator[tuple]:
        a, s, c = self.limits
        while self.n and self.held > down_to:
            tokens, segments, loss, offset = a, s, c, 0
            while self.n and tokens and segments:
                size, bears = self.size[: self.n], self.loss[: self.n]
                # shares of the limits; the segment's share is the same for all that fit
                value = size * (tokens / (a * a)) + bears * (loss / (c * c))
                value[(size > tokens) | (bears > loss)] = -1
                k = int(value.argmax())
                if value[k] < 0:
                    break
                key, start, length, bore = self._take(k)
                yield key, start, length, self.sequence, offset
                tokens, segments, loss, offset = tokens - length, segments - 1, loss - bore, offset + length
            if self.n and tokens and segments:
                # none fits: cut the front of one that can fill most, and of those the one with the fewest quiet tokens
                size, quiet = self.size[: self.n], self.size[: self.n] - self.loss[: self.n]
                use = np.minimum(tokens, np.minimum(size, quiet + loss))
                k = int((use * (a + 1) - np.minimum(quiet, a)).argmax())
                if part := int(use[k]):
                    key, start, length, bore = self._take(k)
                    yield key, start, part, self.sequence, offset
                    if length > part:
                        self._put(key, start + part, length - part, bore - max(0, part - (length - bore)))
                    offset += part
            self.sequence += offset > 0

    def finish(self) -> Iterator[tuple]:
        yield from self._fill(0)


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, n_loss long"
ARROW = pa.schema([(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")])


def pack(docs: DataFrame, tokenizer: str, limits: tuple[int, int, int] = LIMITS, prompt: str | None = None) -> DataFrame:
    """Pieces of sequences for each row of docs (doc_id, text): one row a piece.

    tokenizer: path of a tokenizer file, there on every machine. limits: tokens, segments and loss-bearing tokens of a
    sequence. The first line of a text of more lines is its title and bears no loss. prompt: a column whose tokens come
    before the text's and bear none either; then the whole text bears loss (instruction data). Each example ends with
    END_ID, which bears loss. Null texts and prompts count as empty, so a row gives at least one piece. Rows that repeat
    are packed each; other columns are ignored. An empty table gives no rows. sequence_id is unique over all tasks; a
    retried task gives the same pieces, as its rows come in the same order.
    """
    tune(docs.sparkSession)
    before = F.coalesce(F.col(prompt).cast("string"), F.lit("")) if prompt else F.lit("")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packer = ids_of(tokenizer), Packer(limits)
        first = TaskContext.get().partitionId() << 34
        waiting: dict[int, list] = {}
        end = END_ID.to_bytes(4, "little")
        rows: list[tuple] = []

        def placed(pieces: Iterable[tuple]) -> None:
            for key, start, length, sequence, offset in pieces:
                doc_id, data, left, bore = doc = waiting[key]
                total = len(data) // 4
                loss = max(0, start + length - max(start, total - bore))
                rows.append((doc_id, start, length, zlib.crc32(data[start * 4 : (start + length) * 4]), total, first + sequence, offset, loss))
                doc[2] = left - length
                if not doc[2]:
                    del waiting[key]

        number = 0
        for doc_ids, texts, prompts in _gathered(batches):
            # a title is tokenised once more to know how many tokens it has
            quiet = prompts if prompt else [t[: t.find("\n")] if "\n" in t else "" for t in texts]
            found = ids(texts + quiet)
            for doc_id, data, quiet_ids in zip(doc_ids, found, found[len(texts) :], strict=False):
                whole = (quiet_ids if prompt else b"") + data + end
                bore = (len(whole) - len(quiet_ids)) // 4
                waiting[number] = [doc_id, memoryview(whole), len(whole) // 4, bore]
                placed(packer.add(number, len(whole) // 4, bore))
                number += 1
            if rows:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=ARROW)
                rows.clear()
        ids.forget()
        placed(packer.finish())
        if rows:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=ARROW)

    return docs.select(docs.doc_id.cast("long").alias("doc_id"), docs.text.cast("string").alias("text"), before.alias("before")).mapInArrow(run, SCHEMA)


def pack_conversations(turns: DataFrame, tokenizer: str, limits: tuple[int, int, int] = INSTRUCTION_LIMITS) -> DataFrame:
    """Pieces of sequences for each conversation of turns (conv_id, turn, role, text); doc_id is the conversation's.

    The last answer (role assistant) bears loss, what comes before it doesn't; what comes after it is left to it. A
    conversation without an answer bears loss at its end alone. Turns go by turn, then by role and text; null ones come
    first. Null texts count as empty, null conv_id is one conversation; other columns are ignored. An empty table gives no rows.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    said = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(turn)).alias("said"))
    answers = F.transform("said", lambda x, n: F.when(x["role"] == "assistant", n + 1))
    said = said.withColumn("first", F.coalesce(F.array_max(answers), F.size("said") + 1))

    def words(start: Column, size: Column) -> Column:
        return F.array_join(F.transform(F.slice("said", start, size), lambda x: x["text"]), "\n")

    rows = said.select("doc_id", words(F.lit(1), F.col("first") - 1).alias("prompt"), words(F.col("first"), F.size("said")).alias("text"))
    return pack(rows, tokenizer, limits, prompt="prompt")


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Rows of several batches together, until they have PART characters."""
    held, size = ([], [], []), 0
    for batch in batches:
        texts, before = [x or "" for x in batch.column(1).to_pylist()], batch.column(2).to_pylist()
        for column, more in zip(held, (batch.column(0).to_pylist(), texts, before), strict=True):
            column.extend(more)
        size += sum(map(len, texts)) + sum(map(len, before))
        if size >= PART:
            yield held
            held, size = ([], [], []), 0
    if held[0]:
        yield held
