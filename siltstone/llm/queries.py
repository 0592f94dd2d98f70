"""One thin query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import crc_remainder, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.line_dedup import remove_repeated_lines

    return remove_repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.lm import score_texts

    docs = table(spark, sf_dir, "documents")
    out = score_texts(docs, train_where=crc_remainder(docs["doc_id"], 7) != 2)
    return out.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from siltstone.llm.packing import pack_documents

    out = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op4_media_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.ogg import read_streams, store_samples

    out = read_streams(store_samples(table(spark, sf_dir, "documents")))
    return out.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.mixing import document_rates, fit_rates, learn_domains

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    model = learn_domains(docs, labels.select("doc_id", domain.alias("_y")), 3)
    rates = fit_rates(docs, model, [0.85, 0.12, 0.03])
    out = document_rates(docs, model, rates)
    return out.select("doc_id", "n_tokens", *[F.col("posterior")[k].alias(f"p_{n}") for k, n in enumerate(("good", "low", "toxic"))], "rate", "copies")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.toxicity import THRESHOLD, learn_toxicity, score_toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = learn_toxicity(docs, labels, where=crc_remainder(labels["doc_id"], 3) != 1)
    out = score_toxicity(docs.select("doc_id", "text"), machine)
    return out.select("doc_id", (crc_remainder(out["doc_id"], 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.pii import replace_entities

    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), b"siltstone demonstration key")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.substring_dedup import remove_repeated_windows

    out = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.vector_dedup import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_lm_scores, op3_packing, op4_media_ogg, op5_minhash, op6_mixing, op7_toxicity, op8_pii_surrogates, op9_substring_dedup, op10_vector_dedup)}


def oracle_sql() -> dict[str, str]:
    from siltstone.llm.line_dedup import SQL as lines

    from siltstone.llm.substring_dedup import SQL as substrings
    from siltstone.llm.vector_dedup import SQL as vectors

    return {"op1_line_dedup": lines, "op9_substring_dedup": substrings, "op10_vector_dedup": vectors}
