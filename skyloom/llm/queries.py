"""One query for each operator, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, langid, licences, mixing, oracles, packing, quality, sharding, simhash, spelling, spsample, topk, whitening, wordpiece
from .common import load


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spsample.encode_sampled(load(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op2_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign_shards(load(spark, sf_dir, "documents"), sharding.SMALL_SHARD)
    return found.select(F.col("id").alias("doc_id"), F.col("bytes").alias("n_bytes"), F.col("depth").cast("int").alias("depth"), F.col("prefix").alias("prefix"), "page")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "embeddings")
    return topk.top_k(table, table.where(F.col("vec_id") % 50 == 0), k=5)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"), width=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.assess(load(spark, sf_dir, "documents"))
    return found.withColumn("distance", F.round("distance", 6))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.packed_pieces(load(spark, sf_dir, "documents"), tokenizer=tokenizer_file("byte_bpe_50k.json"), end_id=0, length=1024)
    return found.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "conversations")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    # apart, so that a stored conversation with the probe's id is not mixed with it
    parted = lambda rows: chat.format_chats(rows.select("conv_id", "turn", "role", chat.parts_of(F.col("text")).alias("parts")), parts="parts")
    done = parted(table).unionByName(parted(probe)).withColumn("turns", chat.read_turns(F.col("formatted")))
    said_again = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.read_text(s["text"])), "")
    references = F.array_join(F.transform("attachments", lambda a: F.concat_ws(" ", a["turn_index"].cast("string"), a["kind"], a["tokens"].cast("string"), a["uri"])), "\n")
    done = done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.char_length("formatted").cast("long").alias("formatted_chars"), said_again.alias("said"), loss.alias("loss"),
        F.size("attachments").cast("long").alias("n_attachments"), "attachment_tokens", references.alias("attachments"),
    )
    return done.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_attachments",
        "attachment_tokens",
        "attachments",
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(load(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wordpiece.token_counts(load(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(load(spark, sf_dir, "documents"))
    return found.withColumn("licences", F.array_join("licences", ","))


def op11_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.by_time(mixing.mix(load(spark, sf_dir, "documents")))
    again = F.try_element_at(F.transform("passes", lambda p: p["time"]), F.lit(2))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", F.round("time", 9).alias("first_time"), F.round(again, 9).alias("second_time"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.spelling_variants(load(spark, sf_dir, "documents"), spoil=31)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_sentencepiece_sampling,
            op2_extendible_shards,
            op3_exact_top_k,
            op4_simhash,
            op5_quality_rules,
            op6_packing,
            op7_chat_format,
            op8_language_id,
            op9_token_counts,
            op10_license_scan,
            op11_curriculum_mix,
            op12_whitening,
            op13_spelling_variants,
        )
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
