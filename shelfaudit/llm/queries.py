"""The registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfaudit.llm import quality, toxicity
from shelfaudit.llm.alignment import alignment
from shelfaudit.llm.bpe_tree import bpe_encode, read_vocabulary
from shelfaudit.llm.common import fold_of, table
from shelfaudit.llm.decontaminate import decontaminate
from shelfaudit.llm.exact_dedup import exact_dedup
from shelfaudit.llm.hard_negatives import hard_negatives
from shelfaudit.llm.license_scan import license_scan
from shelfaudit.llm.lm import lm_scores
from shelfaudit.llm.mixing import mix
from shelfaudit.llm.secret_scan import KINDS, fit_formats, secret_scan
from shelfaudit.llm.simhash import simhash_near_dedup
from shelfaudit.llm.token_counts import token_counts


def op1_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _classified(docs: DataFrame, score, folds: int, held_fold: int, cut: float) -> DataFrame:
    scored = docs.select("doc_id", (fold_of(F.col("doc_id"), folds) == held_fold).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), folds=4, held_fold=2)
    return _classified(docs, quality.score_column(model, F.col("text")), 4, 2, quality.CUT)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), folds=3, held_fold=1)
    return _classified(docs, toxicity.score_column(model, F.col("text")), 3, 1, toxicity.CUT)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_near_dedup(table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), folds=7, held_fold=2).withColumnRenamed("id", "doc_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10).withColumnRenamed("id", "doc_id")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan(docs, fit_formats(docs))
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))

    def written(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: Tokenizer files of the encoding and alignment queries.
BYTE_BPE, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(PIECES, "rb") as f:
        found = alignment(table(spark, sf_dir, "documents"), read_vocabulary(BYTE_BPE), f.read())
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_encode(table(spark, sf_dir, "documents"), read_vocabulary(BYTE_BPE), decode=True)
    return found.select(
        F.col("id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license": op1_license,
    "op2_quality": op2_quality,
    "op4_lm": op4_lm,
    "op5_toxicity": op5_toxicity,
    "op3_simhash": op3_simhash,
    "op6_mixing": op6_mixing,
    "op7_decontaminate": op7_decontaminate,
    "op8_secrets": op8_secrets,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_alignment": op11_alignment,
    "op12_bpe": op12_bpe,
    "op13_hard_negatives": op13_hard_negatives,
}
