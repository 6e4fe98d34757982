"""Registered queries: every operator over its whole table, digests included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, chat, codes, decontamination, divergence, langid, lines, pagetext, quality, secrets, simhash, substrings, topk
from strata.llm.common import read_tables

QUALITY_FROM = 0.3


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_tables(spark, sf_dir, "documents", "benchmark")
    reported, name = decontamination.contamination(docs, benchmark)
    r = f"`{name}`"
    return reported.select(
        "doc_id", F.col(f"{r}.n_words"), F.col(f"{r}.n_hit"), F.col(f"{r}.n_items"),
        F.sha2(F.array_join(f"{r}.items", ","), 256).alias("items_sha256"),
        F.col(f"{r}.contaminated"))


def word_bpe_path() -> str:
    """The public word-level vocabulary file that the contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, = read_tables(spark, sf_dir, "documents")
    coded = bpe.round_trip(docs.select("doc_id", "text"), word_bpe_path())
    return coded.select(
        "doc_id", F.expr("octet_length(coded.ids) div 4").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"), F.sha2("coded.decoded", 256).alias("decoded_sha256"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, = read_tables(spark, sf_dir, "documents")
    found, name = lines.dedup_lines(docs.select("doc_id", "text"))
    n = f"`{name}`"
    return found.select("doc_id", F.col(f"{n}.n_removed"), F.array_join(f"{n}.removed", ",").alias("removed"),
                        F.sha2(F.coalesce(f"{n}.kept", F.lit("")), 256).alias("kept_sha256"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, = read_tables(spark, sf_dir, "documents")
    found, name = substrings.remove_repeats(docs.select("doc_id", "text"))
    f = f"`{name}`"
    return found.select("doc_id", F.col(f"{f}.n_words"), F.col(f"{f}.n_removed"),
                        F.sha2(f"{f}.kept", 256).alias("kept_sha256"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, = read_tables(spark, sf_dir, "documents")
    found, name = secrets.find_secrets(docs.select("doc_id", "text"))
    spans = F.col(f"`{name}`")
    base = F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    listed = lambda items: F.array_join(F.transform(
        items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, = read_tables(spark, sf_dir, "embeddings")
    scaled = vectors.select("vec_id", F.transform(
        topk.usable(F.col("embedding")), lambda x: F.floor(x * 64).cast("double")).alias("embedding"))
    return topk.top_k(scaled, scaled.where(F.col("vec_id") % 20 == 0)).select(
        "query_id", "rank", "vec_id", F.col("score").cast("bigint").alias("score"))


def _turn(of: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % of


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, = read_tables(spark, sf_dir, "documents")
    held_out = F.coalesce(_turn(3) == 1, F.lit(False))
    model = langid.train(docs, ~held_out)
    said = docs.select("doc_id", held_out.alias("held_out"), langid.identify(docs, model).alias("said"))
    return said.select("doc_id", "held_out", F.col("said.lang").alias("lang_pred"),
                       F.col("said.score").alias("score"))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Trees:
    """The classifier of the contract: rows of a fifth of the ids are held out."""
    return quality.train(docs, labels, F.coalesce(_turn(5) != 0, F.lit(False)))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_tables(spark, sf_dir, "documents", "labels")
    scored = docs.select("doc_id", F.coalesce(_turn(5) == 0, F.lit(False)).alias("held_out"),
                         quality.score(docs, quality_model(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_FROM).cast("int"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, = read_tables(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, = read_tables(spark, sf_dir, "pages")
    text = pagetext.extract(pages, pagetext.train(pages))
    return pages.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, = read_tables(spark, sf_dir, "documents")
    return divergence.audit(docs)


CONTROL_STRINGS = r"\### Assistant: </turn> ok"      # fixed value: text of conversation -7


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, = read_tables(spark, sf_dir, "conversations")
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_STRINGS).alias("text"))
    turns = turns.select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digests(chat.format_chats(chat.events_of(turns))).withColumnRenamed("conv", "conv_id")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, = read_tables(spark, sf_dir, "embeddings")
    coded, books = codes.compress(vectors)
    hex_code = F.array_join(F.transform("code", lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")), "")
    return coded.select(F.col("id").alias("vec_id"), hex_code.alias("code"), "error", "label_error",
                        F.lit(books.digest() if books else "").alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1,
    "op2_bpe_encoding_and_decoding": op2,
    "op3_line_dedup": op3,
    "op4_substring_dedup": op4,
    "op5_secret_scans": op5,
    "op6_exact_top_k_search": op6,
    "op7_language_id": op7,
    "op8_simhash_near_dedup": op8,
    "op9_quality_classifier": op9,
    "op10_html_extraction": op10,
    "op11_source_divergence_audit": op11,
    "op12_chat_formatting": op12,
    "op13_vector_code_compression": op13,
}
