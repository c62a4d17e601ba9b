"""License scans: an exact set-similarity join of text blocks with license templates, and exact phrase places.

In scan() a block is any run of consecutive words of the document, wherever its lines break, that is a quarter (two
words at least) longer than the template it is held against. In matches() a block is a line. A template is a set of
words; a block matches it if it holds at least `threshold` of them (containment, counted on sets). Words are ordered by how often they occur in the whole corpus, rarest first, and a
block can only match if

* it holds one of the template's first `size - needed + 1` words in that order (prefix filter),
* it has at least `needed` words (length filter),
* the words of the template from the shared one on can still reach `needed` (positional filter: the shared one is the
  template's first, in the order, that the block has),

where `needed` is the smallest count that reaches the threshold. What passes is counted out, so the result is exact. Of
runs of words only those around an occurrence of a prefix word are looked at, all of them, one word apart.
Templates are a parameter; their number is checked, as they travel with the plan. Blocks are never compared with each
other, and only blocks with a prefix word leave the row of their document.

A null or empty text has no words and no labels. Identical rows give identical results; an empty table gives no rows;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantflow.llm import common

MAX_TEMPLATES = 10_000
#: Phrases whose places are counted, with their labels. Fixed values.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
THRESHOLD = 0.9


@dataclass(frozen=True)
class Template:
    label: str
    text: str


TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("mit", "Released under the MIT License."),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    Template("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    Template("agpl", "licensed under the GNU Affero General Public License"),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    Template("public-domain", "This work has been released into the public domain."),
)


def words_of(text: str) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(common.SEPARATOR_RUN, lowered) if w]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(common.ascii_lower(text), common.SEPARATOR_RUN), "")


def _places(words: Column, joined: Column, phrase: str) -> Column:
    """Starts of the phrase, words counted from 0. Only texts that hold it at all are walked."""
    own = phrase.split(" ")
    there = lambda i: F.array([words[i + k] for k in range(len(own))]) == F.array(*map(F.lit, own))
    last = F.size(words) - len(own)
    found = F.filter(F.sequence(F.lit(0), last), there)
    return F.when(joined.contains(f" {phrase} "), found).otherwise(F.array().cast("array<int>"))


def frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """In how many documents each of these words occurs. One row a word comes back."""
    words = F.array_intersect(_words(F.coalesce(F.col(text_col), F.lit(""))), F.array(*map(F.lit, vocabulary)))
    rows = docs.select(F.explode(words).alias("word")).groupBy("word").count().collect()
    return {r["word"]: r["count"] for r in rows}


def ordered(docs: DataFrame, templates: tuple[Template, ...], text_col: str = "text") -> list[tuple[str, list[str], int]]:
    """Labels, word sets and run lengths of the templates, rarest word of the corpus first, ties by the word."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    sets = [(t.label, sorted(set(words_of(t.text))), run_length(t.text)) for t in templates]
    sets = [x for x in sets if x[1]]
    seen = frequencies(docs, sorted({w for _, words, _ in sets for w in words}), text_col) if sets else {}
    return [(label, sorted(words, key=lambda w: (seen.get(w, 0), w)), length) for label, words, length in sets]


def run_length(text: str) -> int:
    """Words of the runs that are held against a template."""
    n = len(words_of(text))
    return n + max(2, n // 4)


class _Join:
    """The templates as frames: their prefix words, and what verification needs."""

    def __init__(self, docs: DataFrame, templates, threshold: float, text_col: str):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be above 0, and 1 at most")
        rows, details = [], []
        for number, (label, words, length) in enumerate(ordered(docs, templates, text_col)):
            needed = math.ceil(threshold * len(words) - 1e-9)
            details.append((number, label, words, needed, length))
            rows += [(w, number, place) for place, w in enumerate(words[: len(words) - needed + 1])]
        spark = docs.sparkSession
        self.prefixes = spark.createDataFrame(rows, "word string, template int, place int")
        self.details = spark.createDataFrame(details, "template int, label string, words array<string>, needed int, length int")
        self.longest = max((d[4] for d in details), default=1)
        self.least = min((d[3] for d in details), default=1)
        self.rare = F.array(*map(F.lit, sorted({r[0] for r in rows}))).cast("array<string>")

    def pairs(self, candidates: DataFrame, *keys: str) -> DataFrame:
        """candidates: keys and __text of the documents that hold a prefix word."""
        blocks = (
            candidates.select(*keys, F.posexplode(F.split("__text", "\n")).alias("line", "__line"))
            .select(*keys, "line", F.array_distinct(_words(F.col("__line"))).alias("__block"))
            .filter(F.size("__block") >= self.least)
        )
        shared = F.size(F.array_intersect("words", "__block"))
        return (
            blocks.withColumn("word", F.explode(F.array_intersect("__block", self.rare)))
            .join(F.broadcast(self.prefixes), "word")
            .join(F.broadcast(self.details), "template")
            .filter((F.size("__block") >= F.col("needed")) & (F.size("words") - F.col("place") >= F.col("needed")))
            # one row a pair: the one of the first shared word
            .filter(F.forall(F.slice("words", F.lit(1), F.col("place")), lambda w: ~F.array_contains("__block", w)))
            .filter(shared >= F.col("needed"))
            .select(*keys, "line", "template", "label", (shared / F.size("words")).alias("containment"))
        )

    def runs(self, candidates: DataFrame, *keys: str) -> DataFrame:
        """Like pairs, with a row for each occurrence of a prefix word that has a matching run around it."""
        most = self.longest

        def around(words: Column) -> Column:
            places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(self.rare, words[i]))
            first = lambda i: F.greatest(i - (most - 1), F.lit(0))
            return F.transform(
                places,
                lambda i: F.struct(words[i].alias("word"), (i - first(i)).alias("at"), F.slice(words, first(i) + 1, i - first(i) + most).alias("around")),
            )

        found = candidates.select(*keys, F.explode(common.let(_words(F.col("__text")), around)).alias("__place"))
        placed = (
            found.select(*keys, "__place.word", F.col("__place.at").alias("__at"), F.col("__place.around").alias("__around"))
            .join(F.broadcast(self.prefixes), "word")
            .join(F.broadcast(self.details), "template")
            .filter(F.size("words") - F.col("place") >= F.col("needed"))
            .withColumn("__near", F.expr("slice(__around, greatest(__at - length + 1, 0) + 1, least(__at, length - 1) + length)"))
            .filter(F.size("__near") >= F.col("needed"))
            .filter(F.size(F.array_intersect("words", "__near")) >= F.col("needed"))
        )
        shared = F.expr(
            "array_max(transform(sequence(0, greatest(size(__near) - length, 0)), k -> size(array_intersect(words, slice(__near, k + 1, length)))))"
        )
        return (
            placed.withColumn("__shared", shared)
            .filter(F.col("__shared") >= F.col("needed"))
            .select(*keys, "template", "label", (F.col("__shared") / F.size("words")).alias("containment"))
        )


def matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col="doc_id", text_col="text") -> DataFrame:
    """A row for each document, line and template whose containment reaches the threshold.

    Returns the id, line (from 0), template (its number), label and containment.
    """
    join = _Join(docs, templates, threshold, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    candidates = docs.select(F.col(id_col), text.alias("__text")).filter(F.arrays_overlap(_words(F.col("__text")), join.rare))
    return join.pairs(candidates, id_col)


def phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: Column | None = None) -> DataFrame:
    """Per document: its words, the places of the fixed phrases, their labels; its text if it holds a word of rare."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(F.col(id_col), text.alias("__text"), _words(text).alias("__words"))
    rare = F.array().cast("array<string>") if rare is None else rare
    joined = words.withColumn("__joined", F.concat(F.lit(" "), F.array_join("__words", " "), F.lit(" ")))
    columns = [_places(F.col("__words"), F.col("__joined"), p).alias(f"__p{k}") for k, (p, _) in enumerate(PHRASES)]
    placed = joined.select(
        id_col,
        F.size("__words").cast("long").alias("n_words"),
        F.xxhash64("__text").alias("__key"),
        F.when(F.arrays_overlap("__words", rare), F.col("__text")).alias("__text"),
        *columns,
    )
    starts = [F.col(f"__p{k}") for k in range(len(PHRASES))]
    labels = F.array(*(F.when(F.size(s) > 0, F.lit(label)) for s, (_, label) in zip(starts, PHRASES, strict=True)))
    return placed.select(
        id_col,
        "n_words",
        "__key",
        "__text",
        F.concat(*starts).alias("starts"),
        F.array_sort(F.array_distinct(F.array_compact(labels))).alias("base"),
    )


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: phrase places, base labels, all labels, and score.

    score is 1.0 where a phrase stands, else the highest containment of a matching template, else 0.0. Texts are read
    twice: for the word frequencies, and for phrases and candidates, which are kept for the join.
    """
    join = _Join(docs, templates, threshold, text_col)
    rows = common.cut(phrases(docs, id_col, text_col, join.rare))
    candidates = rows.filter(F.col("__text").isNotNull()).select(F.col(id_col).alias("__id"), F.col("__key").alias("__of"), "__text")
    per_doc = (
        join.runs(candidates, "__id", "__of")
        .groupBy("__id", "__of")
        .agg(F.collect_set("label").alias("__labels"), F.max("containment").alias("__best"))
    )
    both = rows.join(per_doc, rows[id_col].eqNullSafe(per_doc["__id"]) & (rows["__key"] == per_doc["__of"]), "left")
    found = F.coalesce("__labels", F.array().cast("array<string>"))
    return both.select(
        id_col,
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("__best", F.lit(0.0))).alias("score"),
    )
