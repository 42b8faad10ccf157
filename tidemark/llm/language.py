"""Language identification in two steps: the family first, then one-versus-one linear machines within the family.

Features are hashed byte trigrams of the A-Z-lowered text, as shares of all its trigrams. Both steps are linear support
vector machines with hinge loss, fitted by dual coordinate descent on a bounded sample of labelled rows. Prediction adds
up weights over a whole text and keeps no table of its trigrams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tune

UNKNOWN = "und"
BITS = 14
#: Bound of the sample that the machines are fitted on: rows of a language, and bytes of such a row that are read.
ROWS_PER_LANGUAGE = 400
ROW_BYTES = 20_000
#: Rows of all languages; many languages share them evenly, each has one at least.
SAMPLE_ROWS = 4000
ROUNDS = 30
TOLERANCE = 1e-3
COST = 10.0
#: Rows that are dense at a time while products of rows are taken.
BLOCK = 512
SCALE = 50.0

# Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
    "sinitic": ("zh",), "japonic": ("ja",), "koreanic": ("ko",),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def trigrams(text: bytes) -> np.ndarray:
    """Hashed byte trigrams of a text with a space before and after it."""
    b = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
    h = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) if len(b) > 2 else b[:0]
    return (h * np.uint32(2654435761)) >> np.uint32(32 - BITS)


@dataclass
class Rows:
    """Sparse feature rows: row n has values[starts[n] : starts[n + 1]] at columns[...]; gram: their products, and 1."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    gram: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Rows:
        columns, values = [], []
        for text in texts:
            g = trigrams(text)
            found, n = np.unique(g, return_counts=True)
            columns.append(found)
            values.append((n * (SCALE / max(1, len(g)))).astype(np.float32))
        starts = np.concatenate([[0], np.cumsum([len(c) for c in columns])]).astype(np.int64)
        rows = cls(starts, np.concatenate(columns), np.concatenate(values), np.ones((len(texts), len(texts)), np.float32))
        # only BLOCK rows at a time are dense
        for i in range(0, len(texts), BLOCK):
            left = rows.dense(i)
            for j in range(0, i + 1, BLOCK):
                product = left @ (left if i == j else rows.dense(j)).T
                rows.gram[i : i + BLOCK, j : j + BLOCK] += product
                if i != j:
                    rows.gram[j : j + BLOCK, i : i + BLOCK] += product.T
        return rows

    def dense(self, at: int) -> np.ndarray:
        ends = self.starts[at : at + BLOCK + 1]
        out = np.zeros((len(ends) - 1, 1 << BITS), np.float32)
        low, high = ends[0], ends[-1]
        out[np.repeat(np.arange(len(out)), np.diff(ends)), self.columns[low:high]] = self.values[low:high]
        return out

    def sum_of(self, which: np.ndarray, factors: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << BITS)
        for n, a in zip(which.tolist(), factors.tolist(), strict=True):
            if a:
                own = slice(self.starts[n], self.starts[n + 1])
                out[self.columns[own]] += a * self.values[own]
        return out.astype(np.float32)


def fit_machine(rows: Rows, which: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (hinge loss) on some rows, by dual coordinate descent; y is -1 or 1.

    A round looks only at the rows that still break the conditions of the optimum by more than TOLERANCE.
    """
    gram = rows.gram if len(which) == len(rows.gram) else rows.gram[np.ix_(which, which)]
    alpha, f = np.zeros(len(y)), np.zeros(len(y))
    cost = COST * np.where(y > 0, len(y) / max(1, 2 * (y > 0).sum()), len(y) / max(1, 2 * (y < 0).sum()))
    for _ in range(ROUNDS):
        slack = 1 - y * f
        late = np.flatnonzero(((slack > TOLERANCE) & (alpha < cost)) | ((slack < -TOLERANCE) & (alpha > 0)))
        if not len(late):
            break
        for i in late.tolist():
            step = min(max(alpha[i] + (1 - y[i] * f[i]) / gram[i, i], 0.0), cost[i]) - alpha[i]
            if step:
                alpha[i] += step
                f += step * y[i] * gram[i]
    a = alpha * y
    return rows.sum_of(which, a), float(a.sum())


@dataclass
class Model:
    """families: for each its languages; for each family a machine against the others (one for two families); and for
    each pair of a family's languages a machine."""

    families: list[tuple[str, list[str]]]
    one_vs_rest: tuple[np.ndarray, np.ndarray]
    pairs: list[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]


def fit(rows: list[tuple[bytes, str]]) -> Model | None:
    """Fit on (text, language); None if there are no rows."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return None
    groups: dict[str, list[str]] = {}
    for lang in langs:
        groups.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
    families = sorted(groups.items())
    x = Rows.of([text for text, _ in rows])
    lang = np.array([r[1] for r in rows])
    family = np.array([FAMILY_OF.get(r[1], r[1]) for r in rows])
    names = [f for f, _ in families]
    every = np.arange(len(rows))
    heads = [fit_machine(x, every, np.where(family == f, 1.0, -1.0)) for f in (names[:1] if len(names) == 2 else names if len(names) > 2 else [])]
    pairs = []
    for _, members in families:
        at = [(a, b) for a in range(len(members)) for b in range(a + 1, len(members))]
        fitted = []
        for a, b in at:
            rows_of = np.flatnonzero((lang == members[a]) | (lang == members[b]))
            fitted.append(fit_machine(x, rows_of, np.where(lang[rows_of] == members[a], 1.0, -1.0)))
        pairs.append((at, *_stack(fitted)))
    return Model(families, _stack(heads), pairs)


def _stack(machines: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray]:
    if not machines:
        return np.zeros((1 << BITS, 0), np.float32), np.zeros(0)
    return np.ascontiguousarray(np.stack([w for w, _ in machines], 1)), np.array([b for _, b in machines])


def _sure(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2 * margin, -30, 30))))


def predict(model: Model | None, text: bytes) -> tuple[str, float]:
    """The language and how sure it is, 0 to 1. Without a letter or a model: und, 0."""
    if model is None or not any(map(str.isalpha, text.decode("utf-8", "replace"))):
        return UNKNOWN, 0.0
    g = trigrams(text)

    def margins(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        if not len(bias):
            return np.zeros(0)
        if len(bias) <= 4:
            return np.array([weights[:, k].take(g).sum(dtype=np.float64) for k in range(len(bias))]) * (SCALE / len(g)) + bias
        n = np.bincount(g, minlength=1 << BITS)
        there = np.flatnonzero(n)
        return (n[there] * (SCALE / len(g))) @ weights[there] + bias

    m = margins(*model.one_vs_rest)
    if len(model.families) == 2:
        best, score = (0, _sure(m[0])) if m[0] > 0 else (1, _sure(-m[0]))
    elif len(model.families) > 2:
        best = int(m.argmax())
        score = _sure(m[best])
    else:
        best, score = 0, 1.0
    members = model.families[best][1]
    at, weights, bias = model.pairs[best]
    votes, least = np.zeros(len(members)), np.full(len(members), np.inf)
    for (a, b), v in zip(at, margins(weights, bias), strict=True):
        votes[a if v > 0 else b] += 1
        least[a], least[b] = min(least[a], v), min(least[b], -v)
    k = max(range(len(members)), key=lambda i: (votes[i], least[i], -i))
    return members[k], score * (_sure(least[k]) if at else 1.0)


def training_rows(docs: DataFrame) -> list[tuple[bytes, str]]:
    """The bounded sample: of each language, the rows with the smallest hashes, of long texts the beginning."""
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN)).select(
        F.substring(F.col("text").cast("binary"), 1, ROW_BYTES).alias("text"), F.col("lang").cast("string").alias("lang"), F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("crc")
    )
    known = known.filter(F.pmod("crc", F.lit(4)) != 2)
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().orderBy("lang").collect()}
    if not counts:
        return []
    rows = max(1, min(ROWS_PER_LANGUAGE, SAMPLE_ROWS // len(counts)))
    # a hash below this has about twice the rows that are needed, and some more where few are needed
    limits = [(lang, min(1 << 31, int((1 << 31) * (2.0 * rows + 20) / n))) for lang, n in counts.items()]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, limit long")
    hashed = known.withColumn("at", F.pmod(F.xxhash64("crc"), F.lit(1 << 31)))
    drawn = hashed.join(F.broadcast(limits), "lang").filter(F.col("at") < F.col("limit")).select("text", "lang", "at").collect()
    missing = sorted(counts.keys() - {r.lang for r in drawn})
    if missing:
        # where identifiers repeat, rows share a hash, and all of a language's rows may lie above the limit
        drawn += hashed.filter(F.col("lang").isin(missing)).groupBy("lang").agg(F.min(F.struct("at", "text")).alias("least")).select("least.text", "lang", "least.at").collect()
    out, taken = [], dict.fromkeys(counts, 0)
    for r in sorted(drawn, key=lambda r: (r.lang, r["at"], bytes(r.text))):
        if taken[r.lang] < rows:
            taken[r.lang] += 1
            out.append((bytes(r.text), r.lang))
    return out


def any_language() -> Model:
    """A model of one unnamed language: every text with a letter is in it."""
    return fit([(b"", "mis")])


def known_only(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs (text, and any other columns) whose language can be told: a text with a letter, by the model.

    Each row is judged by its own text, so identifiers may be null or repeat. Null and empty texts go. An empty table
    gives no rows.
    """
    tune(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([t.is_valid and predict(model, t.as_buffer().to_pybytes())[0] != UNKNOWN for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The predicted language of each row of docs (doc_id, text, and lang to learn from, unless a model is given).

    Rows learned from have text and a lang other than und, and a CRC-32 of doc_id with a remainder by 4 other than 2. Null text, and text
    without a letter: und, score 0; so are all rows if there is nothing to learn from. A null doc_id counts as an empty
    one. Rows that repeat give rows that repeat; other columns are ignored.
    """
    tune(docs.sparkSession)
    model = model or fit(training_rows(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(model, t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], schema=ARROW)

    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.pmod(crc, F.lit(4)) == 2).alias("held_out"), F.col("text").cast("binary").alias("text")).mapInArrow(run, SCHEMA)
