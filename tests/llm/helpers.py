"""Rows that every corpus operator has to take, and plain forms of the contracts."""

import zlib

from pyspark.sql import functions as F

EDGES = [
    (1, "The quick brown fox jumps over the lazy dog. Released under the MIT License.", "en", "src1"),
    (2, None, "en", None),
    (3, "", None, "src1"),
    (4, " \t\n ", "fr", "src2"),
    (None, "Le chat noir est sur la table et il mange.", "fr", "src2"),
    (5, "12345 !!! ???", "de", "src3"),
    (6, "Licensed under the Apache License, Version 2.0. " * 3, "en", "src3"),
    (6, "Licensed under the Apache License, Version 2.0. " * 3, "en", "src3"),
    (7, "wort " * 30_000, "de", "src4"),
    (8, "Ärger Über Öl日本語 \x1c\x85\xa0x", "de", "src4"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators use inside.
CLASHING = ("size", "shard", "row", "range", "part", "key", "node", "region", "label", "root", "block", "kind", "held_out", "score", "n_words", "words", "gram", "id_hash",
            "_id", "_hash", "_stays", "_n", "_row", "doc", "id", "n", "stays", "text_hash", "row_key", "asked", "salt", "lost", "first", "component", "term", "docs", "h1", "form", "spans")


def documents(spark, rows=None):
    df = spark.createDataFrame(EDGES if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def lower(text):
    return (text or "").encode().lower()
