"""License scans: word pairs vote for template offsets, and full or nearly full diagonals are spans."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, order_id, text_key, whole_text
from tidemark.llm.license_texts import BSD_2_CLAUSE, ISC, MIT

#: What parts the words of a lower-cased text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2
#: Templates of so many words do without pairs of two common words, which any text has: the other pairs tell their places.
LONG = 20
COMMON = frozenset("a an and any as be by for from in is not of on or other that the this to with without".split())


class Template(NamedTuple):
    """A text to look for, its label, and the share of its pairs that must stand in their order."""

    text: str
    label: str
    base: bool = False
    share: float = 1.0

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(BETWEEN, self.text.lower()) if w]

    @property
    def pairs(self) -> list[tuple[int, str, str]]:
        """(place, word, next word) of the pairs that vote."""
        words = self.words
        every = [(at, words[at], words[at + 1]) for at in range(len(words) - 1)]
        return [p for p in every if len(words) < LONG or not {p[1], p[2]} <= COMMON]


#: The phrases of the contract, and then lines of well-known public licenses with the share that must match.
TEMPLATES = (
    Template("gnu general public license", "gpl", True),
    Template("apache license", "apache", True),
    Template("cc by", "cc-by", True),
    Template("mit license", "mit", True),
    Template("gnu lesser general public license", "lgpl"),
    Template("gnu affero general public license", "agpl"),
    Template("mozilla public license", "mpl"),
    Template("creative commons attribution", "cc-by"),
    Template("licensed under the apache license version 2 0", "apache", False, 0.8),
    Template("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", False, 0.8),
    Template("redistribution and use in source and binary forms with or without modification are permitted", "bsd", False, 0.8),
    Template("this program is free software you can redistribute it and or modify it under the terms of", "gpl", False, 0.8),
    Template(MIT, "mit", False, 0.8),
    Template(ISC, "isc", False, 0.8),
    Template(BSD_2_CLAUSE, "bsd", False, 0.8),
)


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(template, at, known, gram) of the pairs of consecutive words of the templates: no more rows than they have words."""
    rows = []
    for number, template in enumerate(templates):
        if not template.pairs:
            raise ValueError("a template has two words at least, and not common ones only")
        rows += [(number, *pair) for pair in template.pairs]
    literal = F.array(*[F.struct(F.lit(n).alias("template"), F.lit(at).alias("at"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, at, a, b in rows])
    grams = spark.range(1).select(F.inline(literal))
    return grams.select("template", "at", F.concat_ws(" ", "a", "b").alias("known")).withColumn("gram", F.xxhash64("known"))


def _pick(number: Column, values: Sequence) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), number)


def license_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, slack: int = 2) -> DataFrame:
    """One row per document version and place of a template, and one with a null template per version.

    Columns: doc, version, copies, n_words, template, start, end (in words) and score, the share of the template's pairs
    found there. The pairs of all words are joined with the templates by hash and, for certainty, by the pair itself;
    the votes of a template and offset are one diagonal. Diagonals at most slack apart merge for templates that may match
    in part, so words put in or left out don't end a span; those of the contract need a full diagonal each. Templates may
    have any number of words: a pair of the template is counted once in a span, by its place, so no list of votes is kept.
    """
    spark = docs.sparkSession
    text = whole_text(F.col("text"))
    named = docs.select(order_id(F.col("doc_id")).alias("doc"), text_key(text).alias("version"), F.split(lower_ascii(text), BETWEEN).alias("parts"))
    named = named.select("doc", "version", F.filter("parts", lambda w: w != "").alias("words"))
    pairs = F.transform("words", lambda w, i: F.concat_ws(" ", w, F.get(F.col("words"), i + 1)))
    marked = named.select("doc", "version", F.size("words").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), pairs)).alias("pos", "pair"))
    grams = F.broadcast(template_grams(spark, templates))
    same = (F.xxhash64(F.col("pair")) == F.col("gram")) & (F.col("pair") == F.col("known"))
    voted = marked.join(grams, same, "left").where(F.col("template").isNotNull() | (F.col("pos") == 0))
    votes = voted.groupBy("doc", "version", "template", (F.col("pos") - 1 - F.col("at")).alias("start"), "at").agg(
        F.max("n_words").alias("n_words"), F.sum(F.when(F.col("pos") == 0, 1).otherwise(0)).alias("copies")
    )
    whole = _pick(F.col("template"), [t.share >= 1 for t in templates])
    order = Window.partitionBy("doc", "version", "template").orderBy("start")
    apart = F.col("start") - F.lag("start").over(order)
    islands = votes.withColumn("new", F.when(apart <= F.when(whole, 0).otherwise(slack), 0).otherwise(1))
    islands = islands.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = [F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"), F.min("start").alias("start")]
    places = islands.groupBy("doc", "version", "template", "island", "at").agg(*ends, F.max("start").alias("last"))
    spans = places.groupBy("doc", "version", "template", "island").agg(*ends, F.max("last").alias("last"), F.count("at").alias("votes"))
    scored = spans.withColumn("score", F.col("votes") / _pick(F.col("template"), [len(t.pairs) for t in templates]))
    verified = scored.where(F.col("template").isNull() | (F.col("score") >= _pick(F.col("template"), [t.share for t in templates])))
    end = F.least(F.col("last") + _pick(F.col("template"), [len(t.words) for t in templates]), F.col("n_words"))
    return verified.select("doc", "version", "copies", "n_words", "template", F.greatest("start", F.lit(0)).alias("start"), end.alias("end"), "score")


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """A row for every row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans.

    score is the best share of a template found, 0 without any. Null and empty texts have no words and no labels; repeated
    rows give repeated rows; a null doc_id stays null. Columns other than doc_id and text are not read.
    """
    spans = license_spans(docs, templates)
    spans = spans.withColumns({"base": F.coalesce(_pick(F.col("template"), [t.base for t in templates]), F.lit(False)), "label": _pick(F.col("template"), [t.label for t in templates])})
    label_list = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = spans.groupBy("doc", "version").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sum("copies").cast("int").alias("copies"),
        F.sum(F.when(F.col("base"), 1).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
        label_list(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        label_list("label").alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
        F.count("template").alias("n_spans"),
    )
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    doc_id = F.when(F.col("doc") != F.lit((1 << 63) - 1), F.col("doc")).alias("doc_id")
    return each.select(doc_id, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans")
