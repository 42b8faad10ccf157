"""How far the sources of a language lie apart in their words: an inverted index of corrections to a baseline.

Each pair of sources starts at V times the distance f of two zero counts, as if neither had a kept term. Postings then
emit what differs from that, and nothing where it is zero:

* a posting on its own, against the other's zero count. That correction depends on the posting's count alone, so the
  postings of a source are summed by count before they meet the other sources of the language;
* two postings of one term, for what the two single corrections get wrong where they meet.

All sums are of integers, so their order doesn't matter. Shares are computed as decimals: a count times a thousand
million doesn't fit a long.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import release, stored, tune

#: A term is kept in a language if at least so many of its documents have it.
MIN_DOCS = 30
#: Added to every count; a share of 1 is SCALE.
ADDED, SCALE = 5, 1_000_000_000
#: Terms of a source that are reported.
TOP = 50

#: Counts of so many terms are held before they are passed on, and so many bytes are cut into terms at a time.
HELD, STEP = 400_000, 1 << 20

COUNTS = "lang string, source string, term string, n long, docs long"
ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
#: Bytes of UTF-8: capitals to small letters, and ASCII that is no letter to spaces.
SPACED = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a step of it at a time; steps end between terms."""
    at = 0
    while at < len(text):
        step = text[at : at + STEP].translate(SPACED)
        if at + STEP < len(text) and step[-1] != 32:
            # up to the last space; a term without one goes on until it ends
            if (end := step.rfind(b" ") + 1) > 0:
                step = step[:end]
            else:
                while at + len(step) < len(text) and SPACED[text[at + len(step)]] != 32:
                    step += text[at + len(step) : at + len(step) + STEP].translate(SPACED).split(b" ", 1)[0]
        yield step.split()
        at += len(step)


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and rows with each term; a null term counts a group's rows.

    Each task sums what it has read, up to HELD terms at a time, so a frequent term of a large source is a row a task,
    not a row a document.
    """
    tune(docs.sparkSession)

    def flushed(held: dict[tuple[str, str], list]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, rows_with, rows) in held.items():
            size = len(n) + 1
            terms = pa.array([None, *n], pa.binary()).cast(pa.string())
            columns = [[0, *n.values()], [rows, *map(rows_with.__getitem__, n)]]
            yield pa.record_batch([pa.array([lang] * size), pa.array([source] * size), terms, *[pa.array(c, pa.int64()) for c in columns]], schema=ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list] = {}
        size = 0
        for batch in batches:
            for text, lang, source in zip(*batch.columns, strict=True):
                group = held.setdefault((lang.as_py(), source.as_py()), [Counter(), Counter(), 0])
                before, seen = len(group[0]), set()
                for terms in terms_of(text.as_py()):
                    group[0].update(terms)
                    seen.update(terms)
                group[1].update(seen)
                group[2] += 1
                size += len(group[0]) - before
                if size >= HELD:
                    yield from flushed(held)
                    held, size = {}, 0
        yield from flushed(held)

    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    read = docs.select(text, lang, source).mapInArrow(run, COUNTS)
    # tasks have summed already, so rows are summed where all of a term meet, not before
    return read.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, v: str) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * v)), exactly; null without kept terms."""
    wide = lambda x: f"cast({x} as decimal(19,0))"
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * ({wide(n)} + {ADDED})) div nullif({wide(total)} + {ADDED} * {wide(v)}, 0)")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of each language and source in docs (text, lang, source).

    Part `pair`: item is another source of the language, value the distance of the two over all kept terms (0 without
    any). Part `term`: item is a kept term that the source uses more than its language does, value by how much; the
    first `top` of them. Ranks go by value, ties by the item's bytes. A null in any of the three columns is an empty
    text; rows that repeat count each; other columns are ignored. Empty table: no rows.
    """
    # a term's rows are one a source, and lie in one partition already
    of_term = W.partitionBy("lang", "term")
    found = counted(docs).withColumns({"lang_n": F.sum("n").over(of_term), "with_term": F.sum("docs").over(of_term)})
    found = stored(found.filter(F.col("term").isNull() | (F.col("with_term") >= min_docs)).drop("docs", "with_term"))
    release(docs.sparkSession)
    postings = found.filter("term is not null")
    langs = postings.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = found.filter("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    groups = stored(groups.withColumn("zero", _share("0", "total", "v")))
    shared = postings.join(groups, ["lang", "source"]).select("lang", "source", "term", _share("n", "total", "v").alias("p"), _share("lang_n", "lang_total", "v").alias("q"), "zero")

    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = shared.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    own = own.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)

    def side(df: DataFrame, x: str, *more: str) -> DataFrame:
        return df.select("lang", *[F.col(c).alias(f"{x}_{c}") for c in ("source", "zero", *more)])

    apart = F.abs(F.col("a_zero") - F.col("b_zero"))
    # without kept terms there are no zero counts either
    base = side(groups, "a", "v").join(side(groups, "b"), "lang").filter("a_source < b_source").select("lang", "a_source", "b_source", F.coalesce(F.col("a_v") * apart, F.lit(0)).alias("value"))
    by_share = shared.groupBy("lang", "source", "zero", "p").agg(F.count("*").alias("n_terms"))
    alone = side(by_share, "a", "p", "n_terms").join(side(groups, "b"), "lang").filter("a_source <> b_source")
    alone = alone.select(
        "lang", F.least("a_source", "b_source").alias("a_source"), F.greatest("a_source", "b_source").alias("b_source"),
        (F.col("a_n_terms") * (F.abs(F.col("a_p") - F.col("b_zero")) - apart)).alias("value"),
    )
    met = side(shared.withColumn("t", F.col("term")), "a", "p", "t").join(side(shared.withColumn("t", F.col("term")), "b", "p", "t").withColumnRenamed("lang", "b_lang"), (F.col("lang") == F.col("b_lang")) & (F.col("a_t") == F.col("b_t")))
    wrong = F.abs(F.col("a_p") - F.col("b_p")) - F.abs(F.col("a_p") - F.col("b_zero")) - F.abs(F.col("a_zero") - F.col("b_p")) + apart
    met = met.filter("a_source < b_source").select("lang", "a_source", "b_source", wrong.alias("value"))
    corrections = alone.unionByName(met).filter("value <> 0")
    pairs = base.unionByName(corrections).groupBy("lang", "a_source", "b_source").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")), F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item"))))
    pairs = pairs.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(own)
