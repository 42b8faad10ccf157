"""Sharding, licenses, language, packing and media on edge rows and against brute force."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tests.conftest import SMALL
from tests.llm.helpers import EDGES, crc, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import language, licenses, packing, sharding, transport

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.mark.parametrize("operator", [sharding.shard, licenses.scan, language.identify, transport.media_column, lambda d: packing.pack(d, TOKENIZER)])
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).count() == 0


def _check_shards(rows, expected, n_shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(expected)
    by = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n_shards
        by[r.shard].append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return by


def test_shard_edges(spark):
    rows = sharding.shard(documents(spark), 3).collect()
    _check_shards(rows, [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in EDGES], 3)


def test_shards_are_near_equal_and_keep_equal_texts(small):
    docs = small.union(small.limit(60).selectExpr("doc_id + 100000", "text", "lang", "source", "n_chars"))
    expected = [(r.doc_id, len(r.text.encode()) + 8, zlib.crc32(r.text.encode())) for r in docs.collect()]
    by = _check_shards(sharding.shard(docs, 8).collect(), expected, 8)
    sizes = [sum(r.size for r in own) for own in by.values()]
    largest = max(n for _, n, _ in expected)
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 4 * largest


def test_a_hot_text_is_divided(spark):
    rows = [(i, "hot " * 50, "en", "s") for i in range(900)] + [(1000 + i, f"cold {i} " * 20, "en", "s") for i in range(600)]
    found = sharding.shard(documents(spark, rows), 6).collect()
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    assert len(sizes) == 6 and max(sizes.values()) < 1.05 * min(sizes.values())


def _base(text):
    words = WORDS.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_base_against_brute_force(spark, small):
    for docs in (documents(spark), small):
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        found = licenses.scan(docs).collect()
        assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found) == Counter((i, *_base(t)) for i, t in texts)
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in found)


def test_license_spans_survive_edits_and_are_placed(spark):
    notice = dict(licenses.TEMPLATES)["bsd"].split()
    edited = notice[:6] + ["newly", "put"] + notice[6:12] + notice[13:]
    rows = [(1, "some words before " + " ".join(edited) + " and after", "en", "s"), (2, "redistribution and use in cooking forms of bread", "en", "s")]
    spans = licenses.license_spans(documents(spark, rows)).collect()
    assert [(r.doc_id, r.label) for r in spans] == [(1, "bsd")] and spans[0].first_word == 3 and 0.75 <= spans[0].likeness < 1


def _plain_spans(text):
    """Spans by plain loops over dictionaries and lists."""
    words = WORDS.findall((text or "").encode().lower().decode())
    out = Counter()
    for label, template in licenses.TEMPLATES:
        t = template.split(" ")
        places = defaultdict(list)
        for k in range(len(t) - 3):
            places[tuple(t[k : k + 4])].append(k)
        votes = defaultdict(set)
        for i in range(len(words) - 3):
            for k in places.get(tuple(words[i : i + 4]), ()):
                votes[i - k].add(k)
        diagonals = sorted(votes)
        groups = []
        for d in diagonals:
            if groups and d - groups[-1][-1] <= licenses.DIAGONAL_GAP:
                groups[-1].append(d)
            else:
                groups.append([d])
        for g in groups:
            best = max(g, key=lambda d: (len(votes[d]), -d))
            coverage = min(1.0, sum(len(votes[d]) for d in g) / (len(t) - 3))
            span, row = " ".join(words[max(best, 0) : max(best, 0) + len(t)]), list(range(len(template) + 1))
            if coverage < licenses.MIN_COVERAGE:
                continue
            for n, a in enumerate(span, 1):
                now = [n]
                for k, b in enumerate(template, 1):
                    now.append(min(row[k - 1] + (a != b), row[k] + 1, now[-1] + 1))
                row = now
            likeness = 1 - row[-1] / max(len(span), len(template))
            if likeness >= licenses.MIN_LIKENESS:
                out[label, max(g[0], 0), g[-1] + len(t) - 1, round(likeness, 9), round(coverage, 9)] += 1
    return out


def test_license_spans_against_plain_loops(spark):
    rng, rows = np.random.default_rng(3), []
    for n in range(60):
        words = [f"w{k}" for k in rng.integers(0, 50, 30).tolist()]
        for _ in range(n % 4):
            own = licenses.TEMPLATES[rng.integers(len(licenses.TEMPLATES))][1].split(" ")
            for at in sorted(rng.integers(0, len(own), rng.integers(0, 1 + len(own) // 8)).tolist(), reverse=True):
                own[at : at + 1] = [[], ["changed"], [own[at], "inserted"]][rng.integers(3)]
            at = int(rng.integers(len(words) + 1))
            words[at:at] = own
        rows.append((n, " ".join(words), "en", "s"))
    got = Counter((r.doc_id, r.label, r.first_word, r.last_word, round(r.likeness, 9), round(r.coverage, 9)) for r in licenses.license_spans(documents(spark, rows)).collect())
    want = Counter({(i, *k): n for i, t, *_ in rows for k, n in _plain_spans(t).items()})
    assert got == want and len(want) > 40


def test_long_templates_and_shuffled_joins(spark):
    """A template of thousands of words, and joins that broadcast nothing: the same spans."""
    rng = np.random.default_rng(8)
    long = [f"l{k}" for k in rng.integers(0, 900, 3000).tolist()]
    own = (("long", " ".join(long)), *licenses.TEMPLATES)
    edited = long[:1000] + ["x"] * 2 + long[1000:2000] + long[2003:]
    rows = [(1, "before it " + " ".join(edited) + " after", "en", "s"), (1, "before it " + " ".join(edited) + " after", "en", "s"), (2, " ".join(long[:900]), "en", "s"), (3, dict(licenses.TEMPLATES)["isc"] + " end", "en", "s")]
    sides = [[(r.doc_id, r.label, r.first_word, r.last_word, r.likeness) for r in licenses.license_spans(documents(spark, rows), own, n).collect()] for n in (licenses.BROADCAST_ROWS, 0)]
    assert sorted(sides[0]) == sorted(sides[1])
    assert [(r[0], r[1], r[2]) for r in sorted(sides[0])] == [(1, "long", 1), (3, "isc", 0)] and 0.9 < sorted(sides[0])[0][4] < 1


def test_long_texts_take_time_in_proportion(spark):
    notice = " ".join(t for _, t in licenses.TEMPLATES)
    rows = [(1, "word other thing more " * 250_000, "en", "s"), (2, f"{notice} " * 1000, "en", "s")]
    started = time.perf_counter()
    found = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert time.perf_counter() - started < 120
    assert found[1].n_words == 1_000_000 and found[1].labels == "" and found[2].score == 1.0 and "mpl-2.0" in found[2].labels


def test_language(spark, small):
    found = {r.doc_id: r for r in language.identify(small).collect()}
    lang = {r.doc_id: r.lang for r in small.collect()}
    held = [i for i in lang if crc(i) % 4 == 2]
    assert all(found[i].held_out == (crc(i) % 4 == 2) for i in lang)
    assert sum(found[i].lang_pred == lang[i] for i in held) >= 0.95 * len(held)
    edges = language.identify(documents(spark)).collect()
    assert len(edges) == len(EDGES)
    for r in edges:
        if r.doc_id in (2, 3, 4, 5):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert 0 <= r.score <= 1


def test_language_of_three_families_and_one_language():
    rows = [(t.encode(), lang) for lang, t in (("en", "the and of to"), ("de", "der und die das"), ("fr", "le et la des"), ("pl", "nie jest się że")) for _ in range(5)]
    model = language.fit(rows)
    assert all(language.predict(model, t)[0] == lang for t, lang in rows)
    assert language.predict(language.fit(rows[:5]), b"anything")[0] == "en"
    assert language.fit([]) is None


def test_every_language_is_learned_whatever_its_number_and_the_size_of_its_texts(spark):
    ids = [i for i in range(2000) if crc(i) % 4 != 2]
    many = [(ids[n], f"text of language {n}", f"x{n:03}", "s") for n in range(130)] + [(ids[130 + n], f"text of language {n}", f"x{n:03}", "s") for n in range(105)]
    same = [(ids[300], "the same identifier", "x999", "s")] * 500
    long = [(ids[400 + n], "wort und der die das " * 2000, "de", "s") for n in range(3)]
    rows = language.training_rows(documents(spark, many + same + long))
    assert {lang for _, lang in rows} == {r[2] for r in many + same + long}
    assert max(len(t) for t, _ in rows) == language.ROW_BYTES and len(rows) <= language.SAMPLE_ROWS
    few = [(ids[500 + n], t, lang, "s") for n in range(5) for lang, t in (("en", "the and of to in that"), ("fr", "le et la des dans que"))]
    found = language.identify(documents(spark, few + long)).collect()
    assert {r.doc_id for r in found if r.lang_pred == "de"} == {r[0] for r in long}


def test_many_languages_are_fitted_in_bounded_memory():
    import resource
    import time

    rng = np.random.default_rng(5)
    letters = [bytes(rng.choice(range(97, 123), 6).tolist()) for _ in range(300)]
    # 300 languages of three syllables each, some of one family
    rows = [(b" ".join(letters[(n + k) % 300] + letters[(n * 7 + k) % 300][:3] for k in range(3)) * 5, f"x{n:03}" if n > 20 else sorted(language.FAMILY_OF)[n]) for n in range(300) for _ in range(13)]
    before, started = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
    model = language.fit(rows)
    assert time.perf_counter() - started < 120 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000
    assert sum(language.predict(model, t)[0] == lang for t, lang in rows[::13]) >= 290


def test_machines_reach_the_optimum_of_the_hinge_loss():
    """Weights by dual coordinate descent against plain subgradient descent on the same loss."""
    texts = [b"the and of to in " * k for k in (1, 2, 3)] + [b"der und die das ist " * k for k in (1, 2, 3)]
    y = np.array([1.0, 1, 1, -1, -1, -1])
    rows = language.Rows.of(texts)
    w, bias = language.fit_machine(rows, np.arange(6), y)
    x = np.concatenate([rows.dense(0), np.ones((6, 1))], 1)

    def loss(v):
        return 0.5 * v @ v + language.COST * np.maximum(0, 1 - y * (x @ v)).sum()

    v = np.zeros(x.shape[1])
    for n in range(1, 4000):
        v -= (v - language.COST * (y * (y * (x @ v) < 1)) @ x) / (n + 50)
    # each row may miss its condition by TOLERANCE
    assert loss(np.append(w, bias)) <= loss(v) * 1.01 + language.COST * language.TOLERANCE * len(y)


def test_the_pipeline_keeps_texts_with_letters_without_labels(spark):
    rows = [(1, "text", None, "s"), (2, None, None, "s"), (3, "12 !", None, "s"), (4, "日本", None, "s"), (5, "also text", "und", "s")]
    assert {r.doc_id for r in corpus_pipeline.keep_known_language(spark, documents(spark, rows), SMALL).collect()} == {1, 4, 5}


def _check_packing(pieces, texts, limits=packing.LIMITS):
    whole = Tokenizer.from_file(TOKENIZER)
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limits[0] and len(own) <= limits[1] and sum(r.n_loss for r in own) <= limits[2]
    return sum(r.length for r in pieces) / (limits[0] * len(sequences))


def test_packing(spark, small):
    rows = [(n, t, lang, s) for n, (_, t, lang, s) in enumerate(EDGES)]
    _check_packing(packing.pack(documents(spark, rows), TOKENIZER).collect(), {i: t for i, t, *_ in rows})
    assert packing.pack(documents(spark), TOKENIZER).select("doc_id").distinct().count() == len({i for i, *_ in EDGES})
    texts = {r.doc_id: r.text for r in small.collect()}
    assert _check_packing(packing.pack(small.coalesce(1), TOKENIZER).collect(), texts) > 0.97


def test_packing_keeps_all_limits(small):
    limits = (512, 3, 300)
    texts = {r.doc_id: r.text for r in small.collect()}
    _check_packing(packing.pack(small.coalesce(1), TOKENIZER, limits).collect(), texts, limits)


def test_titles_bear_no_loss_and_the_third_limit_binds(spark):
    rows = [(n, f"title of {n} words here\n" + "body word " * (30 * (n % 7) + 1), "en", "s") for n in range(200)]
    found = packing.pack(documents(spark, rows).coalesce(1), TOKENIZER, (256, 16, 240)).collect()
    _check_packing(found, {i: t for i, t, *_ in rows}, (256, 16, 240))
    loss = Counter()
    for r in found:
        loss[r.sequence_id] += r.n_loss
    # no packing has fewer sequences than the loss-bearing tokens need
    assert max(loss.values()) == 240 and len(loss) <= sum(loss.values()) / 240 + 2
    whole = Tokenizer.from_file(TOKENIZER)
    assert sum(loss.values()) == sum(len(whole.encode(t.split("\n")[1], add_special_tokens=False).ids) + 1 for _, t, *_ in rows)


def test_instruction_packing_of_conversations(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    found = packing.pack_conversations(turns, TOKENIZER).collect()
    by = defaultdict(list)
    for r in turns.collect():
        by[r.conv_id].append(r)
    texts = {i: "\n".join(r.text or "" for r in sorted(own, key=lambda r: r.turn)) for i, own in by.items()}
    _check_packing(found, texts, packing.INSTRUCTION_LIMITS)
    assert all(r.n_loss <= r.length for r in found) and 0 < sum(r.n_loss for r in found) < sum(r.length for r in found)
    edges = [(1, 0, "user", None), (1, 1, "assistant", "fine answer"), (None, 0, "user", "q"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (3, None, None, None)]
    clash = spark.createDataFrame(edges, "conv_id long, turn long, role string, text string").withColumn("prompt", F.lit("clash")).withColumn("last", F.lit(1))
    got = {r.doc_id: r for r in packing.pack_conversations(clash, TOKENIZER).collect()}
    assert set(got) == {1, None, 2, 3} and got[1].n_loss == 3 and got[None].n_loss == 1 and got[2].doc_tokens == 3
    assert packing.pack_conversations(clash.limit(0), TOKENIZER).count() == 0


def test_prompts_bear_no_loss(spark):
    df = documents(spark, [(i, "answer words here", "en", "s") for i in range(20)]).selectExpr("*", "'a long question that bears none' as prompt")
    rows = packing.pack(df, TOKENIZER, (64, 8, 20), prompt="prompt").collect()
    assert sum(r.n_loss for r in rows) == 20 * 4 and all(sum(r.n_loss for r in rows if r.sequence_id == s) <= 20 for s in {r.sequence_id for r in rows})


def test_ids_are_the_tokenizers(small):
    texts = [r.text for r in small.limit(60).collect()] + ["don't I'LL WE'VE", "\x1ca\x1d b", "ΑΣ ΟΔΟΣ", "İstanbul ﬁ ½ ²3 𝒳", "<|endoftext|>x", "á è́", "日本語 テスト"]
    whole, ids = Tokenizer.from_file(TOKENIZER), packing.Ids(TOKENIZER)
    assert ids.by_word
    for _ in range(2):
        assert ids(texts) == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    long = " ".join(texts * 40)
    packing.PART, part = 5_000, packing.PART
    assert ids([long, "short"])[0] == np.array(whole.encode(long, add_special_tokens=False).ids, "<u4").tobytes()
    packing.PART = part
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.Ids(other)(["plain text"]) == [np.array(Tokenizer.from_file(other).encode("plain text", add_special_tokens=False).ids, "<u4").tobytes()]


def test_media_round_trip(spark):
    rows = transport.media_column(documents(spark)).collect()
    assert len(rows) == len(EDGES)
    want = Counter()
    for i, t, *_ in EDGES:
        p = transport.padded((t or "").encode())
        want[i, len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    assert all(r.counter_errors == 0 and r.n_random_access >= 1 and r.media_bytes % 188 == 0 for r in rows)


@pytest.mark.parametrize("size", [1, 13, 150, 157, 158, 159, 165, 170, 183, 184, 341, 342, 31_999, 32_000, 32_001, 100_003])
def test_stream_sizes(size):
    payload = bytes(n * 7 % 256 for n in range(size))
    data = transport.write_stream(payload)
    es = transport.read_stream(data).streams[transport.ES_PID]
    assert len(data) % 188 == 0 and b"".join(es.packets) == payload and es.counter_errors == 0
    assert es.pts == [n * transport.PES_TICKS for n in range(len(es.pts))] and es.random_access == list(range(len(es.packets)))


def test_stream_faults():
    payload = bytes(range(256)) * 500
    data = transport.write_stream(payload)
    packets = [data[i : i + 188] for i in range(0, len(data), 188)]
    lost = transport.read_stream(b"".join(packets[:20] + packets[21:])).streams[transport.ES_PID]
    assert lost.counter_errors == 1 and b"".join(lost.packets) == payload[transport.PES_BYTES :]
    twice = transport.read_stream(b"".join(packets[:20] + packets[19:])).streams[transport.ES_PID]
    assert twice.duplicates == 1 and b"".join(twice.packets) == payload
    shifted = transport.read_stream(b"noise" + data)
    assert shifted.lost_sync == 5 and b"".join(shifted.streams[transport.ES_PID].packets) == payload
    spoiled = bytearray(data)
    spoiled[10] ^= 1
    assert transport.read_stream(bytes(spoiled)).bad_sections == 1 and not transport.read_stream(bytes(spoiled)).programs
