"""Sharding by extendible hashing: only buckets over the byte limit are split on one more bit of the hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, text_key, whole_text

LIMIT_BYTES = 64 << 20
#: Bits that one round looks at, and bits of a hash word. The second word tells rows apart that are the same in all columns.
STEP, WORD_BITS = 10, 60


def _bits(word: Column, depth: int) -> Column:
    """The first depth bits of a hash word of WORD_BITS."""
    return F.shiftright(word, WORD_BITS - depth)


def _hash_word(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, WORD_BITS // 4), 16, 10).cast("long")


def _directory(rows: DataFrame, limit: int, word: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows with bucket (a text of bits) as far as this hash word splits them, and those that it can't split.

    Rows of different prior bits never share a bucket; the bits of this word go on behind them.
    """
    done, pending, depth = [], rows, 0
    while depth < WORD_BITS:
        low, depth = depth, depth + STEP
        cells = pending.groupBy("prior", _bits(F.col(word), depth).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n"))
        levels = cells.select("prior", "cell", "n_bytes", "n", F.explode(F.sequence(F.lit(low if low == 0 else low + 1), F.lit(depth))).alias("depth"))
        levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
        sums = levels.groupBy("prior", "depth", "prefix").agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        fitting = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
        entries = levels.select("prior", "cell", "depth", "prefix").join(fitting, ["prior", "depth", "prefix"])
        directory = cut(entries.groupBy("prior", "cell").agg(F.min_by(F.struct("depth", "prefix", "shard_bytes", "shard_rows"), "depth").alias("shard")))
        found = pending.withColumn("cell", _bits(F.col(word), depth)).join(directory, ["prior", "cell"], "left")
        name = F.when(F.col("shard.depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(shard.prefix), shard.depth, '0')"))
        done.append(found.where(F.col("shard").isNotNull()).select("row", "n_bytes", F.concat("prior", name).alias("shard"), "shard.shard_bytes", "shard.shard_rows"))
        rest = cells.join(directory, ["prior", "cell"], "left_anti")
        if rest.isEmpty():
            return _union(done), None
        pending = found.where(F.col("shard").isNull()).drop("shard", "cell")
    return _union(done), pending


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def shard_by_bytes(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """Every row's doc_id with n_bytes, shard, shard_bytes and shard_rows.

    shard is the text of hash bits that names a bucket of the directory, empty if all rows fit into one. A bucket holds
    at most limit bytes of UTF-8 text; only a single row that is larger by itself is a bucket over the limit. Null texts
    have 0 bytes. Hash bits come from doc_id and text; where rows that are the same in both are too many for a bucket,
    the bits of a second word go on, which is made from the place of the row in the input. Columns other than doc_id and
    text are not read.
    """
    text = whole_text(F.col("text"))
    named = docs.select(F.col("doc_id").alias("row"), F.octet_length(text).cast("long").alias("n_bytes"), _hash_word(F.concat_ws(":", F.col("doc_id").cast("string"), text_key(text).cast("string"))).alias("word"), F.monotonically_increasing_id().alias("place"))
    rows = cut(named)
    placed, rest = _directory(rows.withColumn("prior", F.lit("")), limit, "word")
    if rest is not None:
        again = rest.withColumns({"prior": F.lpad(F.conv(F.col("word").cast("string"), 10, 2), WORD_BITS, "0"), "word2": _hash_word(F.col("place").cast("string"))})
        second, left = _directory(again, limit, "word2")
        if left is not None:
            raise RuntimeError("two hash words can't part some rows; none may be left out")
        placed = placed.unionByName(second)
    return placed.select(F.col("row").alias("doc_id"), "n_bytes", "shard", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, shards: DataFrame, path: str) -> None:
    """Write docs below path with a folder for each shard; doc_id tells rows apart here."""
    named = shards.select("doc_id", F.concat(F.lit("s"), "shard").alias("shard")).distinct()
    docs.join(named, "doc_id").repartition("shard").write.partitionBy("shard").parquet(path)
