"""The registered queries of this package and, where SQL can express them, their
DuckDB statements (in :mod:`.oracles`)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, filter_audit, html_text, line_quality, mixing, ngram_join, quality_fm, spelling, substring_dedup, suffix_dedup, token_counts,
               token_output, warc)
from ._shared import read, scratch
from .oracles import ORACLE as ORACLE

#: Production parameters.
MIX = {"weights": (5, 2, 1), "share": 1.5, "max_repeats": 2.0, "seed": 11}
TOKENIZER, END_ID, SEPARATOR = "byte_bpe_50k.json", 2, 50256
METADATA = ("n_chars",)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(id_col: str = "doc_id"):
    """Rows that no label is learnt from; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, **MIX).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.contamination(docs, read(spark, sf_dir, "benchmark"), n=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    placed = token_counts.write_flat(docs, tokenizer_path(), scratch(spark, "flat-tokens"), SEPARATOR)
    found = token_counts.count_tokens(placed.select("path"), SEPARATOR)
    return found.join(placed, ["path", "ordinal"]).select("doc_id", "part", "seq", "ordinal", "start", "n_tokens", "terminated")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_earlier(read(spark, sf_dir, "documents"), n=50, digest=True)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents"), n=35, digest=True)


def op7_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    machine = quality_fm.train(docs, read(spark, sf_dir, "labels"), ~held_out(), metadata=METADATA)
    scored = quality_fm.score(docs, machine, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(read(spark, sf_dir, "pages"), scratch(spark, "warc"), min_bytes=0)
    return warc.read(files, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_output.write(read(spark, sf_dir, "documents"), tokenizer_path(), scratch(spark, "token-output"), END_ID)
    return token_output.read_documents(files)


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts, _ = line_quality.judge(read(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_common_words", "base_failed", "kept")


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"), html_text.built_in()).select("page_id", "url", "text", "n_chars")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_texts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(read(spark, sf_dir, "documents"), min_length=6, min_count=5, typo_every=199)
    return spelling.group_variants(words, ratio=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_fm": op7_quality_fm,
    "op8_warc": op8_warc,
    "op9_token_output": op9_token_output,
    "op10_line_quality": op10_line_quality,
    "op11_html_text": op11_html_text,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling": op13_spelling,
}
