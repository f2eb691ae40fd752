"""The registered queries of this folder: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, brown_lm, chat, collocations, html_wrappers, line_dedup, mixing, mpeg, near_vectors, ngram_join, periodic_runs, quality, toxicity
from .common import table

#: Where the public vocabulary files are; a parameter of the operators.
TOKENIZERS = "/opt/tokenizers"


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), 0.9)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "score", "kept")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract_main_text(table(spark, sf_dir, "pages"))


def toxic_held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), toxic_held_out()).select("doc_id", "held_out", "score", "predicted")


def op7_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return brown_lm.score_texts(table(spark, sf_dir, "documents"), ~held_out)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "domain", "n_tokens", "epoch")


def op9_mpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg.audio_digests(mpeg.store_audio(table(spark, sf_dir, "documents")))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    return chat.read_back(chat.chat_segments(turns.unionByName(extra)))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), prepare=periodic_runs.with_repeats))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_near_vectors, op2_bpe, op3_quality, op4_ngram_join, op5_html, op6_toxicity, op7_brown_lm, op8_mixing, op9_mpeg, op10_chat, op11_periodic_runs, op12_line_dedup, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    probe = "'</s>[INST] ok [/INST]'"
    turns = f"(select conv_id, turn, role, text from conversations union all values (-1, 0, 'user', {probe}), (-1, 1, 'assistant', {probe}))"
    return {"op1_near_vectors": near_vectors.oracle(0.9), "op4_ngram_join": ngram_join.oracle(), "op8_mixing": mixing.oracle(), "op10_chat": chat.oracle(turns=turns), "op12_line_dedup": line_dedup.oracle(), "op13_collocations": collocations.oracle()}
