"""The operators applied to the driver's tables, one query each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefkit.llm import (
    chat_format,
    conversation_repair,
    exact_dedup,
    jaccard_join,
    language_id,
    merkle,
    mixing,
    packing,
    quality,
    sharding,
    token_counts,
    url_filter,
    vector_graph,
)
from prefkit.llm.common import id_crc32
from prefkit.llm.oracle import ORACLE_SQL
from prefkit.sources.bindings import table


#: Rules of op1: host/path -> verdict.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def tokenizer_file(name: str) -> str:
    """Where the public tokenizers' file ``name`` lies (the same place on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


def op3_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), length=2048)


def op4_capped_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), share=1.0, max_epochs=3)
    return out.select("doc_id", "size", "source_size", "target", "taken", "epochs")


def op5_naive_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = quality.is_held_out(4, 2)
    found = language_id.identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer_file("piece_bpe_32k.model"), limit=4096)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.jaccard_components(docs, width=3, num=90, den=100)


def op8_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = quality.is_held_out(3, 1)
    ranking = quality.trained_on(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, ranking).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))

def _sha256(text) -> Column:
    return F.sha2(text.cast("binary"), 256)


#: op11's additional conversation: texts that look like the template's own marks.
PLANTED_CONVERSATION = (-7, r"\### Assistant: </turn> ok")


def op11_chat_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, text = PLANTED_CONVERSATION
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    planted = spark.range(2).select(F.lit(conv_id).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(text).alias("text"))
    made = chat_format.format_conversations(conversations.unionByName(planted))
    read = made.select("*", chat_format.read_turns(F.col("formatted")).alias("turns"), chat_format.loss_text(F.col("segments")).alias("learned"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        _sha256(whole).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        _sha256(F.col("learned")).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
        "n_illegal",
    )


def op12_pointer_jumping_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    cut = F.when(id_crc32("doc_id") % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    leaf, tampered = (merkle.row_hash([*map(F.col, ("doc_id", "source", "lang", "n_chars")), t]) for t in (text, cut))
    rows = docs.select("doc_id", "source", leaf.alias("leaf"), tampered.alias("tampered"))
    made = merkle.manifest(rows, group="source", order=["doc_id"], leaf="leaf")
    made = made.withColumn("folded", merkle.folded(F.col("tampered"), F.col("way")))
    shown = {"leaf": F.col("leaf"), "subroot": F.col("subroot"), "root": F.col("root"), "proof_sha256": merkle.proof_hash(F.col("way")), "folded_root": F.col("folded")}
    return made.select("doc_id", *[merkle.text_of(c).alias(name) for name, c in shown.items()], (F.col("folded") == F.col("root")).alias("verified"))


def op13_branch_and_bound_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = conversation_repair.repair(conversation_repair.damaged(conversations))
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = found.select(F.col("conv_id").alias("id"), *counts, "audit", _sha256(F.array_join(lines, "\n")).alias("repaired_sha256"))
    whole = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    return whole.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", _sha256(F.lit(""))).alias("repaired_sha256"),
    )


QUERIES = {f.__name__: f for f in (
    op1_path_templates,
    op2_lpt_sharding,
    op3_swap_packing,
    op4_capped_mix,
    op5_naive_bayes_language,
    op6_transducer_counts,
    op7_jaccard_join,
    op8_grace_dedup,
    op9_pairwise_quality,
    op10_pruned_graph,
    op11_chat_segments,
    op12_pointer_jumping_manifest,
    op13_branch_and_bound_repair,
)}

__all__ = ["ORACLE_SQL", "QUERIES"]
