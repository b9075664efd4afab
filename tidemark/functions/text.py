"""Text, array and address expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"\w+"
NON_WORD = r"\W+"


def word_list(text: Column) -> Column:
    """Every run of word characters, in order of appearance."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def first_items(items: Column, n: int) -> Column:
    return F.slice(items, 1, n)


def counted_items(df: DataFrame, items: str, name: str, times: str) -> DataFrame:
    """A row for each distinct item of a row's array, with the number of its places there; nothing is shuffled."""
    rest = [c for c in df.columns if c != items]
    ordered = df.select(*rest, F.sort_array(items).alias("__items")).where(F.size("__items") > 0)
    at = F.col("__items")
    opens = F.filter(F.sequence(F.lit(0), F.size(at) - 1), lambda i: (i == 0) | ~F.get(at, i).eqNullSafe(F.get(at, i - 1)))
    marked = ordered.withColumn("__opens", opens)
    until = lambda k: F.coalesce(F.get("__opens", k + 1), F.size("__items"))
    runs = F.transform("__opens", lambda i, k: F.struct(F.get("__items", i).alias(name), (until(k) - i).cast("long").alias(times)))
    return marked.select(*rest, F.inline(runs))


def size_then_items(items: Column) -> Column:
    """Sort key for arrays: shorter first, then item by item."""
    return F.struct(F.size(items).alias("size"), items.alias("items"))


def dotted_ipv4(address: Column) -> Column:
    """A 32-bit integer as dotted quad, high byte first; negative means the high bit is set."""
    octets = [F.shiftrightunsigned(address, n).bitwiseAND(F.lit(255)).cast("string") for n in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def escape_tsv(text: Column) -> Column:
    """Text for one field of tab-separated values: tabs, line breaks and backslashes as backslash escapes."""
    for plain, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape_tsv(text: Column) -> Column:
    """What ``escape_tsv`` was given; doubled backslashes part the text first, so they never meet a letter."""

    def plain(part: Column) -> Column:
        for letter, character in (("t", "\t"), ("n", "\n"), ("r", "\r")):
            part = F.replace(part, F.lit(f"\\{letter}"), F.lit(character))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def text_bar(value: Column, low: float, high: float | Column, width: int = 80) -> Column:
    """A horizontal bar of full blocks, ``width`` long at ``high``."""
    high = high if isinstance(high, Column) else F.lit(float(high))
    share = (value - F.lit(low)) / (high - F.lit(low))
    cells = F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * width).cast("int")
    return F.repeat(F.lit("█"), cells)


def case_map(value: Column, mapping: Mapping, default) -> Column:
    """Simple CASE: the mapped value, or the default."""
    out = None
    for key, label in mapping.items():
        hit = value == F.lit(key)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))
