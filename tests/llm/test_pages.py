"""HTML extraction and WARC archives."""

import base64
import hashlib
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL

from tidemark.llm import html_text, queries, warc

SCHEMA = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("text", "data", "refers_to", "sha", "n")})


ARTICLE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li>Menu</ul></nav><div class="ad banner">Buy</div><div id="cookie-notice">We use cookies</div>
<article><header><h1>Title &amp; more</h1></header><p>First   para<b>graph</b>
of text.<p>Second one<br>goes on.<ul><li>item one<li>item two</ul><section><p>Short.</p></section><aside>See also</aside><form>Name <input></form>
<div class="comments"><p>I disagree with all of this.</p></div></article><footer>&copy; me</footer></body></html>"""


def test_article_without_chrome():
    assert html_text.content_blocks(ARTICLE) == ["Title & more", "First paragraph of text.", "Second one goes on.", "item one", "item two", "Short."]


def test_pages_without_an_article():
    long = "words that go on for quite a while, as text does " * 8
    page = f"<body><div class=nav>x</div><div><p>{long}</p><p>{long}</p></div><div>tiny <a>l</a> <a>i</a></div></body>"
    assert html_text.content_blocks(page) == [long.strip()] * 2
    assert html_text.content_blocks("plain text only") == ["plain text only"]
    assert html_text.content_blocks("") == [] and html_text.content_blocks("<p></p><script>x") == []


@pytest.mark.parametrize("box", ["div", "section", "article", "td"])
@pytest.mark.parametrize("size", [3, 40, 4000])
def test_short_blocks_beside_a_long_one_are_kept(box, size):
    blocks = ["A first paragraph that isn't long.", "words " * size + "end", "A second paragraph that isn't long.", "Short.", "A third one, after the short line."]
    inner = "".join(f"<{box}><p>{b}</p></{box}>" for b in blocks)
    menu = "".join(f"<a href=/{n}>l{n}</a> " for n in range(9))
    page = f"<body><nav>menu</nav><div>{menu}</div><div>{'<table><tr>' + inner + '</table>' if box == 'td' else inner}</div><footer>f</footer>"
    assert html_text.content_blocks(page) == blocks


@pytest.mark.parametrize("body", ["<body><p>text", "<p>text", "text", "<div>text</div>", "<body>text</body>"])
def test_a_head_without_its_end_tag_hides_no_text(body):
    for head in ("<head><title>x</title>", "<head>", "<head><meta charset=utf-8><script>var a</script><link rel=x>\n"):
        assert html_text.content_blocks(f"<html>{head}{body}") == ["text"]
    assert html_text.content_blocks("<head><noscript><img src=x></noscript><style>p{}</style></head><p>text") == ["text"]


@pytest.mark.parametrize("name", ["with-sidebar", "content has-sidebar", "post-content no-comments", "sidebar", "header", "content sidebar-right"])
def test_wrappers_that_hold_the_text_are_kept(name):
    text = "words that go on for quite a while, as text does " * 4 + "end"
    for inner in (f"<article><p>{text}</p></article>", f"<p>{text}</p>"):
        assert html_text.content_blocks(f"<body><div class='{name}'>{inner}</div><div class=nav>menu</div></body>") == [text]


@pytest.mark.parametrize("name", ["entry-header", "page-header", "post-header"])
def test_titles_in_a_named_header_are_kept(name):
    page = f"<body><div class=site-header>site</div><article><div class='{name}'><h1>The title</h1></div><p>Text of it.</p><div id=comments-list>no</div></article></body>"
    assert html_text.content_blocks(page) == ["The title", "Text of it."]


@pytest.mark.parametrize("html", ["<p>a &am", "<p>unclosed <b>bold", "</div></p>x", "<div <p>odd", "<!-- open", "<p>\x00퟿</p>", "&#0;&#xD800;&bogus;"])
def test_broken_markup_doesnt_crash(html):
    html_text.content_blocks(html)


@pytest.mark.parametrize("kind", ["div", "p><div", "section class=x", "header", "span"])
def test_deep_nesting_takes_time_in_proportion(kind):
    tag = kind.split(">")[-1].strip("<").split()[0]
    page = "<body>" + "".join(f"<{kind}>text number {n} of it all " for n in range(20_000)) + f"</{tag}>" * 20_000
    started = time.perf_counter()
    found = html_text.content_blocks(page)
    assert time.perf_counter() - started < 20 and (tag == "header") == (not found)


def test_smoothing_keeps_a_constant():
    assert html_text.smoothed([3.0] * 5) == pytest.approx([3.0] * 5)


def test_main_text_rows(spark):
    rows = [(1, "u", ARTICLE), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "u", "<p>" + "w " * 50_000)]
    found = html_text.main_text(pages(spark, rows)).collect()
    assert Counter((r.page_id, r.n_chars == len(r.text)) for r in found) == Counter((r[0], True) for r in rows)
    assert next(r.n_chars for r in found if r.page_id is None) == 99_999
    assert html_text.main_text(pages(spark, [])).count() == 0


def test_warc_rows(spark):
    big = "payload " * 40_000
    rows = [(1, "http://a/", "x"), (2, "u", "x"), (0, "u", "x"), (3, None, None), (4, "u", ""), (5, "line\r\nbreak", big), (6, "u", big), (7, "u", "ü"), (None, "u", "x"), (7, "u", "ü")]
    found = {(r.page_id, r.refers_to): r for r in warc.archive_and_read(pages(spark, rows)).collect()}
    kinds = {0: None, 1: 0, 2: 0, 3: None, 4: 3, 5: None, 6: 5, 7: None, None: 0}
    assert {k for k in found} == set(kinds.items())
    for i, _, html in rows:
        payload = (html or "").encode()
        r = found[i, kinds[i]]
        assert r.payload_bytes == len(payload) and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r.record_type == ("response" if kinds[i] is None else "revisit")
    assert found[5, None].n_chunks == len(big) // warc.CHUNK + 1 and found[6, 5].n_chunks == 1
    assert warc.archive_and_read(pages(spark, [])).count() == 0


def test_small_payloads_can_be_left_alone(spark):
    found = warc.archive_and_read(pages(spark, [(1, "u", "short"), (2, "u", "short")]), min_bytes=100).collect()
    assert [r.record_type for r in found] == ["response"] * 2


def test_chunks_in_order_are_a_warc_file(spark):
    rows = [(1, "http://a/", "x" * 200_000), (2, "http://b/", "y")]
    chunks = warc.write_archive(pages(spark, rows).withColumn("refers_to", F.lit(None).cast("long")).coalesce(1)).orderBy("archive", "record_no", "chunk_no").collect()
    data = b"".join(r.data for r in chunks)
    assert data.count(b"WARC/1.1\r\n") == 2 and data.endswith(b"\r\n\r\n") and max(len(r.data) for r in chunks) <= warc.CHUNK
    again = warc.read_archive(spark.createDataFrame(list(reversed(chunks)), warc.CHUNK_SCHEMA)).collect()
    assert sorted(r.payload_bytes for r in again) == [1, 200_000]


def test_a_damaged_chunk_is_found():
    reader = warc.RecordReader()
    n, _, data, so_far = next(warc.chunks_of(warc.record_pieces(1, "u", memoryview(b"abc"), None)[1]))
    with pytest.raises(ValueError, match="digest"):
        reader.feed(n, data.replace(b"abc", b"abd"), so_far)


def test_queries_run_on_whole_tables(spark):
    n = spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert queries.op6_main_text(spark, SMALL).count() == n and queries.op10_chunked_warc(spark, SMALL).count() == n


@pytest.mark.parametrize(
    ("html", "blocks"),
    [
        ("<body><form><label>Find</label><input><nav>menu</nav><article><h1>Title here</h1><p>An article of a page that a form holds.</p></article><button>Go</button></form></body>", ["Title here", "An article of a page that a form holds."]),
        ("<main><form><p>All that this page has to say.</p><select><option>x</select></form></main>", ["All that this page has to say."]),
        ("<main><h1>Title</h1><form><p>The text of a page stands in a form, as server pages have it.</p></form></main>", ["Title", "The text of a page stands in a form, as server pages have it."]),
        ("<article><p>The text of an article is outside of the form.</p><form><label>Mail</label><p>Sign up here</p></form></article>", ["The text of an article is outside of the form."]),
        *[(f"<article><p>one {x} two</p></article>", ["one two"]) for x in ("<svg><title>t</title></svg>", "<script>a</script>", "<button>b</button>", "<span hidden>c</span>", "<style>d</style>")],
        ("<article><p>one<script>x</script>two</p></article>", ["onetwo"]),
        ("<article><p>so <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>a=2</annotation></math> holds</p></article>", ["so a=2 holds"]),
        ("<main><header><h1>A title in the main part</h1></header><p>And the text below it.</p></main>", ["A title in the main part", "And the text below it."]),
        ("<header><h1>Site</h1></header><main><p>The text of the page.</p></main>", ["The text of the page."]),
    ],
)
def test_forms_inline_elements_and_formulas(html, blocks):
    assert html_text.content_blocks(html) == blocks
