"""The queries of the corpus operators over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.decontaminate import find_contamination
from tidemark.llm.divergence import audit_sources
from tidemark.llm.langid import fit_language_model, held_out, predict_languages
from tidemark.llm.licenses import scan_licenses
from tidemark.llm.linededup import dedup_lines
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.passages import repeated_passages
from tidemark.llm.pieces import encode_pieces, read_model
from tidemark.llm.prefixtrie import prefix_trie
from tidemark.llm.quality import judge_quality
from tidemark.llm.sharding import shard_by_bytes
from tidemark.llm.sql import DIVERGENCE, LINE_DEDUP, PREFIX_TRIE, QUALITY, URLS
from tidemark.llm.tokencounts import count_tokens
from tidemark.llm.urls import judge_urls, rules_table

#: Texts of more tokens than this are over the limit.
TOKEN_LIMIT = 1024
#: Shards that one reader of a training job takes at a time; small tables have several as well.
SHARD_BYTES = 1 << 20

Query = Callable[[SparkSession, str], DataFrame]


def model_path() -> str:
    """The model file of the contract, among the installed public tokenizers; its bytes are what the operator takes."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_path() -> str:
    """The tokenizer file of the contract."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    marked = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit_language_model(marked.where(~F.col("held_out")))
    return predict_languages(marked, model, keep=("doc_id", "held_out"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size", "keeps")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    deduped = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return deduped.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def digests(encoded: DataFrame) -> DataFrame:
    """What tells an encoding: the number of ids, a digest of the ids, one of the decoded text, and the bytes that spans cover."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_span_bytes"),
    )


def op4_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return digests(encode_pieces(table(spark, folder, "documents"), read_model(model_path())))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents")).drop("version")


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_quality(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), rules_table(spark))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(table(spark, folder, "documents"), SHARD_BYTES)


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents"), read_model(token_path()).decode())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit_sources(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_line_dedup": op3_line_dedup,
    "op4_piece_encoding": op4_piece_encoding,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filter": op8_url_filter,
    "op9_sharding": op9_sharding,
    "op10_decontamination": op10_decontamination,
    "op11_token_counts": op11_token_counts,
    "op12_source_divergence": op12_source_divergence,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op3_line_dedup": LINE_DEDUP,
    "op7_quality_rules": QUALITY,
    "op8_url_filter": URLS,
    "op12_source_divergence": DIVERGENCE,
    "op13_prefix_trie": PREFIX_TRIE,
}
