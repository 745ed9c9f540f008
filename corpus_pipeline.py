"""A training corpus from ``documents``, as five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``. Empty tables, nulls and repeated rows are handled
as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricelens.llm import decontam, mixing, ngram_join, quality_fm, token_output
from pricelens.llm._shared import read, scratch, settle
from pricelens.llm.queries import END_ID, METADATA, MIX, held_out, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores at 0.5 or more."""
    machine = quality_fm.train(docs, read(spark, sf_dir, "labels"), ~held_out(), metadata=METADATA)
    scored = quality_fm.score(docs, machine, out="_ll_score")
    return scored.where("_ll_score >= 0.5").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return ngram_join.keep_one(docs, n=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten benchmark words."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"), n=10, remove="documents")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document stands in it as often as it has copies."""
    return mixing.emit(mixing.mix(docs, **MIX), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    files = token_output.write(docs, tokenizer_path(), scratch(spark, "corpus"), END_ID)
    return token_output.read_documents(files)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settle(docs, f"pipeline-{name}")
    return docs
