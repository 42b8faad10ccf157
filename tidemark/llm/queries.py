"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import benchmark, divergence, html_text, infill, language, licenses, near_dups, ngrams, packing, sharding, suffixes, transport, warc
from tidemark.llm.tables import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), n_shards=24)


def op2_diagonal_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score(table(spark, sf_dir, "documents"))


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_transport_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transport.media_column(table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's operator on instruction data."""
    return packing.pack_conversations(table(spark, sf_dir, "conversations"), TOKENIZER)


def op10_chunked_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages")).drop("stored_bytes", "n_chunks")


def op11_radix_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.repeats(table(spark, sf_dir, "documents")))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_rank_select_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.fill_in_middle(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_sampled_splitters, op2_diagonal_licenses, op3_deleted_interpolation, op4_benchmark_leaks, op5_transport_streams, op6_main_text,
        op7_lsh_forest, op8_language, op9_vector_packing, op10_chunked_warc, op11_radix_suffixes, op12_source_divergence, op13_rank_select_infill,
        instruction_packing,
    )
    return {f.__name__: f for f in own}


#: RFC 4648 base32 of a SHA-1: 160 bits cut into 32 letters.
OP10_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p
), b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
    (4 * (position(substr(hex, i::INT, 1) IN '0123456789abcdef') - 1) + 1)::INT, 4)), '') AS bits FROM h
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + 16 * substr(bits, (5 * i + 1)::INT, 1)::INT + 8 * substr(bits, (5 * i + 2)::INT, 1)::INT + 4 * substr(bits, (5 * i + 3)::INT, 1)::INT
       + 2 * substr(bits, (5 * i + 4)::INT, 1)::INT + substr(bits, (5 * i + 5)::INT, 1)::INT)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
FROM b WINDOW w AS (PARTITION BY hex, payload_bytes)
"""


#: Shingles as strings, pairs by a common shingle, components by a recursive walk.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], chr(10)))) END AS shingles FROM w
), n AS (
  SELECT doc_id, len(shingles) AS n_shingles FROM s
), e AS (
  SELECT doc_id, unnest(shingles) AS shingle FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)
), g AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS node, doc_id AS reached FROM n UNION SELECT r.node, g.b FROM r JOIN g ON r.reached = g.a
)
SELECT n.doc_id, n.n_shingles::BIGINT AS n_shingles, min(r.reached) AS component_id, n.doc_id = min(r.reached) AS kept
FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""


#: Windows of 50 bytes are 100 hex digits, taken from stretches of 256 windows: a long string is walked for each place in it.
OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), pieces AS (
  SELECT r, doc_id, cut, x[2 * cut + 1 : 2 * cut + 98 + 512] AS y FROM (SELECT r, doc_id, x, unnest(range(0, length(x) // 2 - 49, 256)) AS cut FROM d WHERE length(x) >= 100)
), w AS (
  SELECT r, doc_id, cut + k AS i, y[2 * k + 1 : 2 * k + 100] AS win FROM (SELECT *, unnest(range(length(y) // 2 - 49)) AS k FROM pieces)
), gone AS (
  SELECT r, i FROM w JOIN (SELECT win, min(doc_id) AS first FROM w GROUP BY win) USING (win) WHERE doc_id > first
), s AS (
  SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM gone)
), spans AS (
  SELECT r, min(i) AS b, max(i) + 50 AS e FROM s GROUP BY r, span
), k AS (
  SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS kb, b AS ke FROM spans UNION ALL SELECT r, max(e), NULL FROM spans GROUP BY r
), t AS (
  SELECT d.r, string_agg(x[2 * kb + 1 : coalesce(2 * ke, length(x))], '' ORDER BY kb) AS kept FROM k JOIN d USING (r) GROUP BY d.r
), c AS (
  SELECT r, sum(e - b) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""


#: Every count of every group, zeros too.
OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30
), vocab AS (
  SELECT lang, count(kept.term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM d UNION ALL SELECT DISTINCT lang, NULL FROM d
), occurs AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d) GROUP BY ALL
), counts AS (
  SELECT lang, source, term, n FROM occurs JOIN kept USING (lang, term) UNION ALL SELECT lang, NULL, term, sum(n) FROM occurs JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM groups g LEFT JOIN counts c ON c.lang = g.lang AND c.source IS NOT DISTINCT FROM g.source GROUP BY ALL
), probs AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 5)) // (t.total + 5 * v) AS BIGINT) AS p
  FROM totals t JOIN vocab USING (lang) JOIN kept k ON k.lang = t.lang LEFT JOIN counts c ON c.lang = t.lang AND c.source IS NOT DISTINCT FROM t.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS xs, y.source AS ys, sum(abs(x.p - y.p)) AS value FROM probs x JOIN probs y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.xs = a.source AND s.ys = b.source
), terms AS (
  SELECT x.lang, x.source, x.term AS item, x.p - y.p AS value FROM probs x JOIN probs y ON x.lang = y.lang AND x.term = y.term AND y.source IS NULL WHERE x.source IS NOT NULL AND x.n > 0 AND x.p > y.p
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), h AS (
  SELECT *, list_transform([1, 9, 17, 25], lambda s: list_reduce(list_transform(range(8), lambda k: instr('0123456789abcdef', substr(x, (s + k)::INT, 1))::BIGINT - 1), lambda a, b: a * 16 + b)) AS h FROM d
), f AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), o AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM o
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_lsh_forest": OP7_SQL, "op10_chunked_warc": OP10_SQL, "op11_radix_suffixes": OP11_SQL, "op12_source_divergence": OP12_SQL, "op13_rank_select_infill": OP13_SQL,
    }
