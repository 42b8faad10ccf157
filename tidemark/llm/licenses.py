"""License scan by diagonal voting, on DataFrame functions only.

Every rolling k-gram of words is hashed and joined to the positions where license templates have the same k-gram. A hit
votes for the diagonal (document position - template position); neighbouring diagonals are merged, so that a few
inserted or missing words don't split a span, and each merged span that has votes enough is verified by edit distance
against its template. Only then is its text taken from the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored

K = 4
#: Template positions up to so many (a row under 50 bytes) are broadcast, and so are candidate spans; beyond it, shuffled.
BROADCAST_ROWS = 500_000
#: Diagonals at most so far apart belong to one span.
DIAGONAL_GAP = 3
#: A span's likeness to its template, 1 - edit distance / longer length, is at least this.
MIN_LIKENESS = 0.75
#: Votes over the template's k-grams are at least this, before the edit distance is taken.
MIN_COVERAGE = 0.4

# Phrases whose places are counted, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Wording of public license notices, lower case, words only.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
)


def words_of(text: Column) -> Column:
    """Maximal runs of a-z, 0-9 and non-ASCII characters of the A-Z-lowered text."""
    return F.array_remove(F.split(_plain(text), " ", -1), "")


def _plain(text: Column) -> Column:
    """The words with one space before, between and after them."""
    return F.regexp_replace(F.concat(F.lit(" "), ascii_lower(text), F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def _places(plain: Column, words: Column, phrase: str) -> Column:
    """Word positions (from 0) where the phrase's words stand one after the other."""
    parts = phrase.split(" ")
    at = F.sequence(F.lit(0), F.size(words) - len(parts))

    def here(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for n, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + n) == part)
        return found

    return F.when(plain.contains(f" {phrase} "), F.filter(at, here)).otherwise(F.array().cast("array<int>"))


def _gram(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + n) for n in range(K)])


def _templates(spark, templates) -> DataFrame:
    """A row a template; its size depends on the templates alone."""
    if any(len(text.split(" ")) < K for _, text in templates):
        raise ValueError(f"a template has {K} words or more")
    rows = [(n, label, text) for n, (label, text) in enumerate(templates)]
    known = spark.createDataFrame(rows, "t_id int, t_label string, t_text string")
    return known.withColumn("t_words", F.split("t_text", " ", -1)).withColumn("t_n", F.size("t_words"))


def _bound(value: Column, make) -> Column:
    """make(value) with value computed once: what a lambda takes from outside is computed again for each element."""
    return F.get(F.transform(F.array(value), make), 0)


def _rolling(words: Column) -> Column:
    """The hash of each k-gram, in order."""
    return _bound(words, lambda w: F.when(F.size(w) >= K, F.transform(F.sequence(F.lit(0), F.size(w) - K), lambda i: _gram(w, i))))


def license_spans(docs: DataFrame, templates=TEMPLATES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Verified spans: doc_id, id_hash, text_hash, label, first_word, last_word, likeness, coverage.

    docs has doc_id and text; other columns are ignored. Rows with the same id and text give the same spans once; spans
    that tie, of one template or of several, are all told. Null or empty texts have none. A template has K words or more.
    Template positions and candidate spans are broadcast up to broadcast_rows of them, and shuffled beyond it.
    """
    key = ["id_hash", "text_hash"]
    known = _templates(docs.sparkSession, templates)
    n_positions = sum(len(text.split(" ")) - K + 1 for _, text in templates)
    positions = known.select("t_id", F.posexplode(_rolling(F.col("t_words"))).alias("t_pos", "gram"))
    texts = docs.select("doc_id", F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash"), "text")
    grams = texts.select(*key, F.posexplode(_rolling(words_of(F.col("text")))).alias("pos", "gram"))
    hits = grams.join(F.broadcast(positions) if n_positions <= broadcast_rows else positions, "gram")
    hits = hits.select(*key, "t_id", "t_pos", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
    # on a diagonal each position of the template is one bit, so copies of a row count once
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t_pos") % 64)
    votes = hits.groupBy(*key, "t_id", "diagonal", F.floor(F.col("t_pos") / 64).alias("part")).agg(F.bit_or(bit).alias("bits"))
    votes = votes.groupBy(*key, "t_id", "diagonal").agg(F.sum(F.bit_count("bits")).alias("votes"))
    near = W.partitionBy(*key, "t_id").orderBy("diagonal")
    merged = (
        votes.withColumn("apart", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(near) > DIAGONAL_GAP).cast("int"), F.lit(0)))
        .withColumn("island", F.sum("apart").over(near))
        .groupBy(*key, "t_id", "island")
        .agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.max_by("diagonal", F.struct("votes", F.negate("diagonal"))).alias("best"))
        .join(F.broadcast(known.select("t_id", "t_n")), "t_id")
        .withColumn("coverage", F.least(F.lit(1.0), F.col("votes") / (F.col("t_n") - (K - 1))))
        .filter(F.col("coverage") >= MIN_COVERAGE)
    )
    merged = stored(merged.groupBy(*key).agg(F.collect_list(F.struct("t_id", "t_n", "low", "high", "best", "coverage")).alias("spans"), F.count("*").alias("n")))
    n_spans = merged.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = merged.drop("n")
    once = texts.join(F.broadcast(found) if n_spans <= broadcast_rows else found, key)

    def told(words: Column) -> Column:
        return F.transform("spans", lambda s: s.withField("span_text", F.array_join(F.slice(words, F.greatest(s["best"], F.lit(0)) + 1, s["t_n"]), " ")))

    placed = once.select("doc_id", *key, F.explode(_bound(words_of(F.col("text")), told)).alias("span")).select("doc_id", *key, "span.*").drop("best")
    # rows that repeat have the same spans: told once, before they are verified
    placed = placed.distinct().join(F.broadcast(known.select("t_id", "t_label", "t_text")), "t_id")
    longer = F.greatest(F.length("span_text"), F.length("t_text"))
    allowed = F.floor((1 - MIN_LIKENESS) * longer + 1e-9).cast("int")
    placed = placed.withColumn("allowed", allowed).withColumn("edits", F.expr("levenshtein(span_text, t_text, allowed)")).filter("edits >= 0")
    return placed.select(
        "doc_id", *key, F.col("t_label").alias("label"), F.greatest(F.col("low"), F.lit(0)).cast("long").alias("first_word"), (F.col("high") + F.col("t_n") - 1).cast("long").alias("last_word"),
        (1 - F.col("edits") / longer).alias("likeness"), "coverage",
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): the counted phrases, and the labels of phrases and verified spans.

    Null and empty texts: no words, no labels, score 0. Rows that repeat give rows that repeat; a null doc_id is a value
    like any other. score is the best verified likeness, 0 without a span.
    """
    spans = (
        license_spans(docs)
        .groupBy("id_hash", "text_hash")
        .agg(F.collect_set("label").alias("found"), F.max("likeness").alias("best"))
    )
    base = docs.select("doc_id", F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash"), _plain(F.col("text")).alias("plain"))
    base = base.withColumn("words", F.array_remove(F.split("plain", " ", -1), "")).select(
        "doc_id", "id_hash", "text_hash", F.size("words").cast("long").alias("n_words"),
        *[_places(F.col("plain"), F.col("words"), phrase).alias(f"p{n}") for n, (phrase, _) in enumerate(PHRASES)],
    )
    places = F.concat(*[F.col(f"p{n}") for n in range(len(PHRASES))])
    named = F.array_compact(F.array(*[F.when(F.size(f"p{n}") > 0, label) for n, (_, label) in enumerate(PHRASES)]))
    base = base.select(
        "doc_id", "id_hash", "text_hash", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"), named.alias("named"),
    )
    out = base.join(spans, ["id_hash", "text_hash"], "left")
    every = F.array_union("named", F.coalesce("found", F.array().cast("array<string>")))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("named")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"), F.coalesce("best", F.lit(0.0)).alias("score"),
    )
