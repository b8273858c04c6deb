"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import (
    chat,
    collocation,
    decontaminate,
    flatgraph,
    multiset,
    packing,
    quality,
    resample,
    secrets,
    simhash,
    sitetree,
    tokencount,
    toxicity,
)
from txlake.llm.common import table
from txlake.llm.oracle import ORACLE  # noqa: F401 - registered beside the queries

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_texts(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitetree.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    examples = chat.expand(rows.unionByName(extra))
    turns = F.when(F.col("example") == F.col("examples") - 1, chat.read_turns(F.col("formatted")))
    loss = chat.unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = examples.select(
        "conv_id", "example", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("size")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    per_example = read.select(
        "conv_id", "example", "loss", "size",
        F.when(F.col("turns").isNotNull(), F.size("turns").cast("long")).alias("n"),
        F.sha2(F.array_join(lines, ""), 256).alias("sha"),
    )
    in_order = F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss"))))
    whole = per_example.groupBy("conv_id").agg(
        F.max("n").alias("n_turns"),
        F.max("sha").alias("turns_sha256"),
        F.array_join(in_order["loss"], "").alias("trained"),
        F.sum("size").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id", "n_turns", "turns_sha256",
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"), "formatted_chars",
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, findings = secrets.scan(table(spark, sf_dir, "documents"))
    spans = secrets.by_blob(findings)
    shown = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    per_blob = spans.select("blob", *map(count, ("assign", "access", "hex")), shown.alias("spans"))
    return paths.join(per_blob, "blob", "left").select(
        F.col("path").alias("doc_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_assign", "n_access", "n_hex")],
        F.sha2(F.coalesce("spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.count_tokens(table(spark, sf_dir, "documents"), TOKENIZER)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multiset.compared(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        multiset.shown(F.col("print")).alias("fingerprint"),
        multiset.shown(F.col("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_html": op2_html,
    "op3_chat": op3_chat,
    "op4_secrets": op4_secrets,
    "op5_tokens": op5_tokens,
    "op6_embeddings": op6_embeddings,
    "op7_decontaminate": op7_decontaminate,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_fingerprints": op11_fingerprints,
    "op12_resample": op12_resample,
    "op13_collocations": op13_collocations,
}
