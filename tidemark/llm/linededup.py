"""Line dedup: range-partitioned line hashes, sorted by document and position, whose first occurrences stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, order_id, text_key, whole_text

MIN_KEY = 10
#: Characters that are stripped at both ends of a line.
STRIPPED = "\t\n\x0b\x0c\r "
#: A line that a third of all documents hold is dealt out to so many slices by the hash of the document.
SLICES = 64


def line_hashes(docs: DataFrame) -> DataFrame:
    """One row per line whose key is long enough: two hashes of the key, the document and the position."""
    lowered = docs.select(order_id(F.col("doc_id")).alias("doc"), text_key(F.col("text")).alias("version"), lower_ascii(F.col("text")).alias("text"))
    lines = lowered.select("doc", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("doc", "version", "pos", F.btrim("line", F.lit(STRIPPED)).alias("key")).where(F.length("key") >= MIN_KEY)
    return keys.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        F.pmod(F.xxhash64("doc"), F.lit(SLICES)).cast("int").alias("slice"),
        "doc", "version", "pos",
    )


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc, version, pos) of every line whose key a smaller document holds.

    The hashes are partitioned by range with a slice of the documents behind them, so that one very frequent line is
    split; within a slice the rows stream by in order of document and position, and all but those of the first document
    go. The first documents of a key's slices, at most SLICES of them, are then compared with each other.
    """
    hashes = line_hashes(docs)
    dealt = hashes.repartitionByRange("h1", "h2", "slice")
    ordered = Window.partitionBy("h1", "h2", "slice").orderBy("doc", "pos")
    streamed = dealt.withColumn("first", F.first("doc").over(ordered))
    later = streamed.where(F.col("doc") != F.col("first")).select("doc", "version", "pos")
    heads = streamed.where(F.col("doc") == F.col("first")).select("h1", "h2", "doc", "version", "pos")
    heads = heads.withColumn("first", F.first("doc").over(Window.partitionBy("h1", "h2").orderBy("doc", "pos")))
    return later.union(heads.where(F.col("doc") != F.col("first")).select("doc", "version", "pos"))


def _run_lengths(positions: Column) -> Column:
    """Sorted positions as lengths of runs by turns kept and dropped, the first one kept."""

    def lengths(p: Column) -> Column:
        starts = F.filter(p, lambda x, k: (k == 0) | (F.get(p, k - 1) != x - 1))
        ends = F.filter(p, lambda x, k: (k == F.size(p) - 1) | (F.get(p, k + 1) != x + 1))
        return F.struct(starts.alias("s"), ends.alias("e"))

    def gaps(r: Column) -> Column:
        return F.flatten(
            F.transform(r["s"], lambda s, k: F.array(s - F.coalesce(F.get(r["e"], k - 1), F.lit(-1)) - 1, F.get(r["e"], k) - s + 1))
        )

    return F.get(F.transform(F.transform(F.array(positions), lengths), gaps), F.lit(0))


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """One row per document that loses lines: doc, version and keep_runs, its bitmap of kept lines as run lengths.

    keep_runs has by turns how many lines stay and how many go; lines behind the last run stay. docs needs doc_id and
    text; a null doc_id counts as the largest. Rows of one doc_id are one document to the owner of a line; those with
    different texts get a bitmap each, told apart by version, and repeated rows share one.
    """
    named = docs.select("doc_id", whole_text(F.col("text")).alias("text"))
    positions = dropped_lines(named).groupBy("doc", "version").agg(F.sort_array(F.collect_set("pos")).alias("positions"))
    return positions.select("doc", "version", _run_lengths(F.col("positions")).alias("keep_runs"))


def _kept_lines(lines: Column, runs: Column) -> Column:
    mask = F.flatten(F.transform(runs, lambda n, k: F.array_repeat(k % 2 == 0, n)))
    return F.get(F.transform(F.array(mask), lambda m: F.filter(lines, lambda _, i: F.coalesce(F.get(m, i), F.lit(True)))), F.lit(0))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Every row of docs with its columns as row, and n_lines, n_dropped, kept_text.

    A null or empty text is one empty line and stays an empty text. Ties can't arise: a key belongs to the smallest
    doc_id. An empty table gives an empty table. Input columns stay within the struct row, so their names can't clash.
    """
    marked = docs.select(F.struct("*").alias("row"), order_id(F.col("doc_id")).alias("doc"), whole_text(F.col("text")).alias("text"))
    marked = marked.withColumn("version", text_key(F.col("text")))
    joined = marked.join(keep_bitmaps(docs), ["doc", "version"], "left")
    cut = joined.select("row", "text", "keep_runs", F.split("text", "\n").alias("lines"))
    kept = cut.select(
        "row", "text", "keep_runs",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("keep_runs").isNotNull(), _kept_lines(F.col("lines"), F.col("keep_runs"))).alias("kept"),
    )
    return kept.select(
        "row", "keep_runs", "n_lines",
        F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("kept_text"),
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """docs with repeated lines taken out of text, and n_chars, where there is such a column, counted anew for these rows."""
    told = dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return told.select(*[F.when(changed, new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
