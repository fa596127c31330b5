"""Native license scan: an exact set-similarity join of text blocks with license templates.

A text's words are cut into blocks of ``2 * stride`` words that start every ``stride`` words, where ``stride`` is the
length of the longest template: any run of words as long as a template lies whole in some block. A block is found for
a template if the block holds at least the template's threshold of the template's different words.

Words are ordered by their frequency in the whole corpus, rarest first (only words of templates can matter, so only those
are counted and kept). With ``o`` the words that must be shared, template and block of ``t`` and ``b`` kept words:

* length filter: ``b >= o``;
* prefix filter: among the first ``t - o + 1`` words of the template, one is in the block, so only blocks with such
  a word are made at all;
* positional filter: sharing the word at places ``i`` and ``j`` (from 1) leaves at most ``1 + min(t - i, b - j)``
  shared words, which must reach ``o``.

Candidates meet in an equi-join on the word; each pair is then verified. Templates of threshold 1 whose words
must stand consecutively (the phrases) are counted place by place within the blocks found for them.

Defined cases: null and empty texts have no words and no label. Repeated rows get a result each. Empty tables give
empty results. Only the id and text columns are looked at, so other columns cannot clash. Words are compared in lower
case; a non-ASCII letter stays a word character.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import WORD, lower_az, small_table


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    threshold: float = 0.8
    phrase: bool = False  # words must stand consecutively, and places are counted


def _phrase(text: str, label: str) -> Template:
    return Template(label, tuple(text.split()), 1.0, True)


def _notice(text: str, label: str, threshold: float = 0.8) -> Template:
    return Template(label, tuple(text.split()), threshold)


# Phrases and their labels.
PHRASES = (
    _phrase("cc by", "cc-by"),
    _phrase("general public license", "gpl"),
    _phrase("all rights reserved", "reserved"),
)
# Usual short notices and the opening words of usual license texts. Kinds of one license that differ in a single word
# must have nearly all words. So must notices that name their license in one word: others have all the rest. Their usual
# shorter forms, which do name it, are notices of their own.
NOTICES = (
    _notice("licensed under the apache license version 2 0", "apache", 1.0),
    _notice("licensed under the apache license version 2", "apache", 1.0),
    _notice("licensed under apache license version 2 0", "apache", 1.0),
    _notice("under the apache license version 2 0", "apache", 1.0),
    _notice("you may not use this file except in compliance with the license", "apache"),
    _notice("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    _notice("licensed under cc by nc 4 0", "cc-by-nc", 0.9),
    _notice("licensed under cc by sa 4 0", "cc-by-sa", 0.9),
    _notice("this work is dedicated to the public domain under cc0", "cc0", 1.0),
    _notice("is dedicated to the public domain under cc0", "cc0", 1.0),
    _notice("this work is licensed under the gnu general public license version 3", "gpl", 0.9),
    _notice("gnu lesser general public license", "lgpl", 1.0),
    _notice("lesser general public license", "lgpl", 1.0),
    _notice("released under the mit license", "mit", 1.0),
    _notice("released under mit license", "mit", 1.0),
    _notice("under the mit license", "mit", 1.0),
    _notice("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    _notice("subject to the terms of the mozilla public license", "mpl", 1.0),
)
TEMPLATES = (*PHRASES, *NOTICES)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(lower_az(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_order(docs: DataFrame, text: str, templates: Sequence[Template]) -> dict[str, int]:
    """Rank of each template word by its frequency over all documents, rarest first; ties by the word."""
    vocabulary = sorted({w for t in templates for w in t.words})
    counts = (
        docs.select(F.explode(F.filter(_words(F.col(text)), lambda w: w.isin(vocabulary))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .collect()  # one row per template word
    )
    n = {r["word"]: r["n"] for r in counts}
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (n.get(w, 0), w)))}


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per document: its id, ``n_words``, places of phrases, labels and ``score``, the largest share found.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are those of phrases; ``labels`` are of all.
    """
    spark = docs.sparkSession
    order = word_order(docs, text, templates)
    stride = max(len(t.words) for t in templates)

    prefix, parts = set(), []
    for t in templates:
        ranked = sorted({order[w] for w in t.words})
        need = max(1, -(-int(round(t.threshold * len(ranked) * 1000)) // 1000))
        first = ranked[: len(ranked) - need + 1]
        names = {order[w]: w for w in t.words}
        prefix |= {names[r] for r in first}
        parts += [
            {
                "label": t.label, "phrase": t.phrase, "sequence": list(t.words), "t": len(ranked), "o": need, "i": i + 1,
                "word": names[r], "ranked": [names[x] for x in ranked],
            }
            for i, r in enumerate(first)
        ]
    known = small_table(
        spark, parts, "label: string, phrase: boolean, sequence: array<string>, t: int, o: int, i: int, word: string, ranked: array<string>"
    )
    vocabulary, prefix = list(order), sorted(prefix)  # the vocabulary is in the global order

    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    worded = docs.select("id", _words(F.col("text")).alias("words")).withColumn("row", F.monotonically_increasing_id())
    # Blocks with a prefix word: the places of such words tell them.
    hit = F.exists("words", lambda w: w.isin(prefix))
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(prefix), i)), lambda i: i.isNotNull())
    numbers = F.array_distinct(
        F.flatten(
            F.transform(
                places, lambda p: F.filter(F.array((p / stride).cast("int") - 1, (p / stride).cast("int")), lambda b: b >= 0)
            )
        )
    )
    found = worded.select(
        "row", "id", F.size("words").alias("n_words"), F.when(hit, F.transform(numbers, lambda b: F.struct(b.alias("b"), F.slice("words", b * stride + 1, F.lit(2 * stride)).alias("block")))).alias("blocks")
    )
    rows = found.select("row", "id", "n_words", F.explode_outer("blocks").alias("x")).select(
        "row", "id", "n_words", F.col("x.b").alias("b"), F.col("x.block").alias("block")
    )
    # The block's template words in the global order: the intersection keeps the order of its first side.
    own = F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), F.coalesce("block", F.array().cast("array<string>")))
    rows = rows.withColumn("own", own)
    keyed = rows.select("row", "id", "n_words", "b", "block", "own", F.posexplode_outer("own").alias("at", "word"))
    keyed = keyed.withColumn("j", F.col("at") + 1)
    size = F.size("own")
    met = keyed.join(F.broadcast(known), "word", "left")  # one row per prefix word of a template
    possible = (size >= F.col("o")) & (1 + F.least(F.col("t") - F.col("i"), size - F.col("j")) >= F.col("o"))
    shared = F.when(possible, F.size(F.array_intersect("own", "ranked")))
    met = met.withColumn("share", F.when(shared >= F.col("o"), shared / F.col("t")))
    # Of a pair met at several words only the first of the template's prefix counts.
    first = F.array_position(F.transform("ranked", lambda w: F.array_contains("own", w)), True) == F.col("i")
    met = met.withColumn("share", F.when(first, F.col("share")))
    starts = F.filter(
        F.sequence(F.lit(0), F.least(F.size("block"), F.lit(stride)) - 1),
        lambda p: F.slice("block", p + 1, F.size("sequence")) == F.col("sequence"),
    )
    met = met.withColumn("starts", F.when(F.col("share").isNotNull() & F.col("phrase"), F.transform(starts, lambda p: p + F.col("b") * stride)))
    phrase_found = F.size("starts") > 0
    notice_found = F.col("share").isNotNull() & ~F.col("phrase")
    out = met.groupBy("row", "id", "n_words").agg(
        F.sum(F.when(phrase_found, F.size("starts")).otherwise(0)).cast("bigint").alias("n_base"),
        F.min(F.when(phrase_found, F.array_min("starts"))).cast("bigint").alias("first_word"),
        F.max(F.when(phrase_found, F.array_max("starts"))).cast("bigint").alias("last_word"),
        F.collect_set(F.when(phrase_found, F.col("label"))).alias("base"),
        F.collect_set(F.when(notice_found, F.col("label"))).alias("notices"),
        F.max(F.when(phrase_found | notice_found, F.col("share"))).alias("score"),
    )
    return out.select(
        F.col("id").alias(doc_id),
        F.col("n_words").cast("bigint").alias("n_words"),
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", "notices")), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
