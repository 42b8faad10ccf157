"""Repeated windows, source divergence and infilling on edge rows and against plain loops."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SMALL
from tests.llm.helpers import EDGES, documents
from pyspark.sql import functions as F

from tidemark.llm import divergence, infill, suffixes

TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.mark.parametrize("operator", [suffixes.repeats, divergence.divergence, infill.fill_in_middle])
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).count() == 0


# repeated windows


def plain_repeats(rows, threshold=50):
    """(doc_id, spans, kept) of each row, window by window."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - threshold + 1 if doc_id is not None else 0):
            w = data[at : at + threshold]
            first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data, covered = (text or "").encode(), set()
        for at in range(len(data) - threshold + 1 if doc_id is not None else 0):
            if first[data[at : at + threshold]] < doc_id:
                covered.update(range(at, at + threshold))
        spans = [(a, next(b for b in range(a, len(data) + 1) if b not in covered)) for a in sorted(covered) if a - 1 not in covered]
        out.append((doc_id, spans, bytes(x for n, x in enumerate(data) if n not in covered)))
    return sorted(out, key=str)


def found_repeats(docs, threshold=50):
    return sorted(((r.doc_id, [tuple(s) for s in r.spans], bytes(r.kept)) for r in suffixes.repeats(docs, threshold).collect()), key=str)


def test_repeats_edges(spark):
    rows = [(d, t) for d, t, *_ in EDGES if len(t or "") < 1000]
    docs = documents(spark, [r for r in EDGES if len(r[1] or "") < 1000])
    assert found_repeats(docs) == plain_repeats(rows)
    everything = {r.doc_id: r for r in suffixes.repeats(documents(spark)).collect()}
    # a text of one word again and again has nothing that another one has; rows that share an identifier take nothing
    assert not everything[7].spans and not everything[6].spans and everything[2].n_bytes == 0


def _mixed_rows(n, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcde éß日 ") for _ in range(rng.choice((30, 49, 50, 51, 80, 200)))) for _ in range(12)]
    rows = []
    for k in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("xyz ü") for _ in range(rng.randrange(1, 90))) for _ in range(rng.randrange(0, 8))]
        text = "".join(parts)
        if rng.random() < 0.3 and text:
            cut = rng.randrange(len(text))
            text = text[:cut] + "#" + text[cut:]
        rows.append((rng.choice((k, k, k // 2, None)) if k % 5 == 0 else k, text, "en", "s"))
    return rows


@pytest.mark.parametrize("threshold", [50, 20])
def test_repeats_against_loops(spark, monkeypatch, threshold):
    rows = _mixed_rows(120, threshold) + [(1000 + k, "ab" * 100, "en", "s") for k in range(3)]
    docs = documents(spark, rows)
    assert found_repeats(docs, threshold) == plain_repeats([r[:2] for r in rows], threshold)


def test_repeats_across_cuts(spark):
    """A text longer than what is looked at together: windows that cross the cut, and copies that start elsewhere."""
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh ", k=suffixes.STEP + 3000))
    lone = "".join(rng.choices("ijklmnop ", k=700))
    at = suffixes.STEP - 40
    rows = [(1, long, "en", "s"), (2, lone + long[at - 60 : at + 200] + lone[::-1], "en", "s"), (3, "!" + long, "en", "s"), (4, long[-60:], "en", "s")]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in suffixes.repeats(documents(spark, rows)).collect()}
    assert got == {1: [], 2: [(700, 960)], 3: [(1, len(long) + 1)], 4: [(0, 60)]}


def test_a_passage_of_all_documents(spark):
    """Every row has the passage, and the passes hold no group of all of them: a task asks once for each digit."""
    passage = "this notice stands in every document of the table and is long enough to count as a copy. "
    rows = [(k, f"{k} begins here {k * 7919} {passage} ends {k * 104729} with number {k}", "en", "s") for k in range(400)]
    docs = documents(spark, rows)
    assert found_repeats(docs) == plain_repeats([r[:2] for r in rows])
    first = suffixes._pass(suffixes._texts(docs, 50).coalesce(1), 1, 50, suffixes._first_digit, ends=True)
    assert first.filter("salt is null").groupBy("d0").count().agg(F.max("count")).first()[0] <= 2 < first.groupBy("d0").count().agg(F.max("count")).first()[0]


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
    return {f.rsplit("/", 1)[-1] for f in found if "/shuffle_" in f}


def test_passes_leave_no_shuffle_files(spark, monkeypatch):
    """Nor do they wait for the driver's garbage to be collected: what passes wrote would add up until then."""
    monkeypatch.setattr(suffixes, "release", lambda spark: None, raising=False)
    docs, before = documents(spark, _mixed_rows(60, 5)), _shuffle_files(spark)
    suffixes.repeats(docs)
    until = time.time() + 5
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left


def test_identifiers_of_any_size(spark):
    """Negative, large and shared ones, and none: which row is smaller is by the identifier, not by what rows are joined by."""
    ids = [0, -1, -(1 << 62), 5, 5, 5, None, None, (1 << 46) - 1, 1 << 46, 1 << 62, (1 << 63) - 1, -(1 << 63)]
    rows = [(ids[k % len(ids)], text, "en", "s") for k, (_, text, *_) in enumerate(_mixed_rows(80, 9))]
    assert found_repeats(documents(spark, rows)) == plain_repeats([r[:2] for r in rows])


def test_halves_of_values():
    """A list of upper halves asks for each value that has one of them; a list of whole values for these alone."""
    value, row = np.array([3 << 40, 7, (1 << 64) - 5], np.uint64), np.array([0, 0, 1])
    whole = suffixes.Asked(pa.array([[3 << 40], [-5]], pa.list_(pa.int64())))
    halves = suffixes.Asked(pa.array([[3 << 8], [-1]], pa.list_(pa.int32())))
    assert whole.has(row, value).tolist() == halves.has(row, value).tolist() == [True, False, True]
    assert halves.has(row, value + np.uint64(1)).tolist() == [True, False, True] != whole.has(row, value + np.uint64(1)).tolist()


@given(st.lists(st.integers(0, 400), min_size=1, unique=True), st.integers(2, 60))
@settings(max_examples=80, deadline=None)
def test_spans(starts, threshold):
    starts = sorted(starts)
    covered = {x for s in starts for x in range(s, s + threshold)}
    spans = suffixes.spans_of(np.array(starts), threshold)
    assert {x for a, b in spans for x in range(a, b)} == covered
    assert all(a not in covered and b not in covered for a, b in ((a - 1, b) for a, b in spans))


# source divergence


def plain_divergence(rows, min_docs, top):
    docs = [(lang or "", source or "", TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        kept = {t for t, n in Counter(t for d in own for t in set(d[2])).items() if n >= min_docs}
        count = {s: Counter(t for d in own for t in d[2] if d[1] == s and t in kept) for s in {d[1] for d in own}}
        whole = Counter(t for d in own for t in d[2] if t in kept)
        p = lambda c, t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, c in count.items():
            pairs = sorted((-sum(abs(p(c, t) - p(o, t)) for t in kept), x.encode(), x) for x, o in count.items() if x != s)
            terms = sorted((p(whole, t) - p(c, t), t.encode(), t) for t in kept if c[t] and p(c, t) > p(whole, t))[:top]
            for part, ranked in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize(("min_docs", "top"), [(30, 50), (3, 4), (10_000, 50)])
def test_divergence_against_loops(spark, small, min_docs, top):
    edges = documents(spark).select("text", "lang", "source")
    docs = small.select("text", "lang", "source").union(edges).union(edges)
    got = sorted(tuple(r) for r in divergence.divergence(docs.withColumns({c: F.lit("clash") for c in ("term", "n", "docs", "value", "p")}), min_docs, top).collect())
    assert got == plain_divergence([tuple(r) for r in docs.collect()], min_docs, top)


def test_shares_are_exact(spark):
    """Counts that no long can hold times a thousand million."""
    rows = [(9_000_000_000_000_000_000, 9_000_000_000_000_000_007, 3), (4_611_686_018_427_387_905, 9_223_372_036_854_775_807, 10_000_000), (0, 0, 0)]
    got = [r[0] for r in spark.createDataFrame(rows, "n long, total long, v long").select(divergence._share("n", "total", "v")).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) if v else None for n, t, v in rows]


@given(st.text(alphabet=st.sampled_from("aBé日 ,1\n[Z"), max_size=60), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_terms_by_steps(text, step):
    """A text that is cut into steps has the same terms, also where one is longer than a step."""
    want = TERMS.findall("".join(c.lower() if c < "\x80" else c for c in text))
    before, divergence.STEP = divergence.STEP, step
    try:
        assert [t.decode() for terms in divergence.terms_of(text.encode()) for t in terms] == want
    finally:
        divergence.STEP = before


def test_counts_are_passed_on(spark, monkeypatch, small):
    monkeypatch.setattr(divergence, "HELD", 50)
    few = sorted(map(tuple, divergence.counted(small).collect()), key=str)
    monkeypatch.undo()
    assert few == sorted(map(tuple, divergence.counted(small).collect()), key=str)


# infilling


def plain_infill(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h, n = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)], len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in infill.MARKS) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}")
    return (doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}")


def test_infill_edges(spark):
    odd = ["<P>", "a<M>b", "<", "<S", ">", "<<S>", "P>x<", "😀" * 40, "é", "日本" * 300, "\U0010ffff\x00a"]
    rows = EDGES + [(100 + k, t * r, "en", "s") for k, t in enumerate(odd) for r in (1, 3)]
    made = infill.fill_in_middle(documents(spark, rows))
    assert sorted((tuple(r) for r in made.collect()), key=str) == sorted((plain_infill(r[0], r[1]) for r in rows), key=str)
    back = made.select("doc_id", infill.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert Counter((r.doc_id, r.t) for r in back) == Counter((r[0], r[1] or "") for r in rows)


def test_infill_digests(small):
    got = {r.doc_id: r for r in infill.digests(infill.fill_in_middle(small)).collect()}
    for r in small.collect():
        want = plain_infill(r.doc_id, r.text)
        assert (got[r.doc_id].n, got[r.doc_id].form, got[r.doc_id].prefix_chars, got[r.doc_id].middle_chars) == want[1:5]
        assert (got[r.doc_id].output_sha256, got[r.doc_id].restored_sha256) == tuple(hashlib.sha256(t.encode()).hexdigest() for t in (want[5], r.text))
    assert {r.form for r in got.values()} == {"plain", "spm", "psm"}


@given(st.lists(st.text(alphabet=st.sampled_from("aé日😀\x00"), max_size=400), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_rank_and_select(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    marks = infill.Boundaries(data)
    starts = [k for k, b in enumerate(data) if b & 0xC0 != 0x80]
    places = np.arange(len(data) + 1)
    assert marks.rank(places).tolist() == [sum(s < p for s in starts) for p in places]
    assert marks.select(np.arange(len(starts) + 1)).tolist() == [*starts, len(data)]
