"""Quality rules: a table of thresholds compiled into one projection of ratios."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

#: Frequent short words of the four languages.
STOP_WORDS = tuple(
    "the of and to in is that was for on are with by at from an as be it this "
    "de la le et les des en un une du est que pour dans au sur par avec "
    "der die und das von zu den mit im ist des ein eine für auf dem "
    "el los las y del se una con por su para lo al".split()
)


class Rule(NamedTuple):
    """A document fails if metric is below least or above most; rows with fewer than from_words words are not measured."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


RULES = (
    Rule("mean_word_length", "chars_per_word", 1.5, 25.0),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("stop_words", "stop_word_share", 0.02, None, 60),
    Rule("repeated_lines", "dup_line_share", None, 0.5),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def _repeated_words(grams: Column) -> Column:
    """Words covered by windows that occur twice; equal 64-bit hashes of windows of one text count as equal windows.

    Texts whose window hashes all differ are told by a set of longs, and nothing is sorted for them.
    """
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    starts = F.transform(
        F.array(placed),
        lambda a: F.sort_array(F.transform(F.filter(a, lambda x, k: (F.get(a, k - 1)["g"] == x["g"]) | (F.get(a, k + 1)["g"] == x["g"])), lambda x: x["i"])),
    )
    covered = F.transform(
        starts,
        lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b),
    )
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.get(covered, F.lit(0))).otherwise(F.lit(0)).cast("long")


def quality_metrics(docs: DataFrame, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Columns keep, then n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the ratios that rules name.

    A null text has no words, no lines and ratios of 0. The counts use whole texts. Each row is measured by itself, so
    repeated rows give repeated rows; columns of docs that are not in keep are dropped, so their names can't clash.
    """
    kept = F.struct(*[F.col(c) for c in keep]).alias("row")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(kept, text.alias("text"))
    base = base.select("row", "text", words_of(F.col("text")).alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    base = base.select("*", hashes.alias("hashes"))
    last = F.size("hashes") - WINDOW
    grams = F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    base = base.select("*", grams.alias("grams"))
    counts = base.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("grams")).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(*STOP_WORDS))).alias("n_stop_words"),
        F.size("lines").alias("n_lines"),
    )
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return counts.select(
        "row.*",
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("chars_per_word"),
        share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_stop_words", "n_words").alias("stop_word_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def compile_rules(rules: Iterable[Rule]) -> Column:
    """An array of the names of the rules that a row of metrics fails."""
    failed = []
    for rule in rules:
        bad = F.lit(False)
        if rule.least is not None:
            bad = bad | (F.col(rule.metric) < rule.least)
        if rule.most is not None:
            bad = bad | (F.col(rule.metric) > rule.most)
        failed.append(F.when(bad & (F.col("n_words") >= rule.from_words), F.lit(rule.name)))
    return F.array_compact(F.array(*failed, F.lit(None).cast("string")))


def judge_quality(docs: DataFrame, rules: Iterable[Rule] = RULES, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Metrics, base_failed, failed_rules and kept for every row of docs."""
    judged = quality_metrics(docs, keep).withColumns({"base_failed": base_failed(), "failed_rules": compile_rules(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(docs: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """The rows of docs that pass, with all their columns; null texts and texts of fewer than ten words don't."""
    judged = judge_quality(docs.select(F.struct("*").alias("whole"), F.col("text").alias("text")), rules, keep=("whole",))
    # inline() keeps the filter above the projection, which would else be computed once more for the filter.
    return judged.select(F.inline(F.array(F.struct("whole", "kept")))).where("kept").select("whole.*")
