"""One query per operator, over the whole tables of a folder, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import (
    chat_format,
    embedding_dedup,
    kd_sharding,
    lexical_bags,
    line_templates,
    packing,
    phrases_era,
    pii,
    repetition,
    sentencepiece_rounds,
    simhash,
    suffix_dedup,
    topk_nra,
)
from marketloom.llm.common import utf8_bytes
from marketloom.llm.oracle import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select(
        "doc_id",
        (utf8_bytes(F.col("text")) + 16).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
        "lang",
        "source",
    )
    dimensions = {"bytes": F.log2("size"), "lang": F.col("lang"), "source": F.col("source")}
    sharded = kd_sharding.kd_shards(docs, F.col("size"), dimensions, F.col("text_hash"), shards=40)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_rounds.encode(docs, "text", model, ids="ids", decoded="decoded")
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.simhash_components(docs, "doc_id", "text", words=4, distance=4)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return repetition.quality(docs, "text").drop("text")


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, "doc_id", "text", width=100)


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_pieces(docs, "text", tokenizer, packing.CAPACITY), packing.CAPACITY)


def op7_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    cleaned = line_templates.drop_template_lines(docs, "text")
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, "text", keep_text=False)
    return found.select(
        "doc_id",
        *[pii.count_kind("base_spans", k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(pii.spans_text("base_spans"), 256).alias("base_sha256"),
        pii.spans_text("spans").alias("spans"),
    )


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    saying = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", saying), (-7, 1, "assistant", saying)], turns.schema)
    formatted = chat_format.format_turns(turns.unionByName(extra), "conv_id", "turn", "role", "text")
    return chat_format.read_back(formatted, "conv_id")


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return embedding_dedup.embedding_components(vectors, "vec_id", "embedding", cosine=0.95)


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("text", "lang")
    return phrases_era.collocations(docs, "text", "lang", least=30, top=2000)


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    items = _table(spark, folder, "benchmark").select("item_id", "text")
    return lexical_bags.search(docs, "doc_id", "text", items, "item_id", "text", k=20)


def op13_topk_nra(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    asked = vectors.where(F.col("vec_id") % 50 == 0)
    found = topk_nra.top_k(vectors, asked, "vec_id", "embedding", k=5, scale=256)
    return found.withColumnRenamed("found_id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kd_sharding": op1_kd_sharding,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_simhash": op3_simhash,
    "op4_quality_rules": op4_quality_rules,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_line_templates": op7_line_templates,
    "op8_pii": op8_pii,
    "op9_chat_format": op9_chat_format,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_phrases": op11_phrases,
    "op12_lexical_search": op12_lexical_search,
    "op13_topk_nra": op13_topk_nra,
}
