"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.llm import chat, chosenpath, decontaminate, jaccard, langid, linededup, merkle, packing, pii, repair, topk, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    told = chat.format_trees(chat.linear_threads(stored.unionByName(added)))
    turns = chat.read_back(F.col("formatted"))
    loss = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    told = told.select(F.col("tree").alias("conv_id"), "formatted", turns.alias("turns"), loss.alias("loss"))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


def _held_out(folds: int, fold: int):
    return F.crc32(F.col("doc_id").cast("string")) % folds == fold


def toxicity_model(spark: SparkSession, documents: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").where(~_held_out(5, 0))
    return toxicity.fit(documents, labels.select("doc_id", F.col("toxic").alias("label")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = toxicity.score(documents, toxicity_model(spark, documents, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(_held_out(5, 0), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.fit(documents.where(~_held_out(3, 1)).select("text", "lang"))
    predicted = langid.predict(documents, model)
    return predicted.select("doc_id", F.coalesce(_held_out(3, 1), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    base = F.sha2(pii.listed(F.col("base")), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(documents).select("doc_id", "text", "n_lines", "n_removed")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, payloads=False).drop("url")


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.drop("curve_key")


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    shown = F.when(tampered, merkle.leaf(n_chars=F.try_add("n_chars", F.lit(1))))
    proved = merkle.manifest(table(spark, sf_dir, "documents"), shown)
    return proved.drop("lang")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "conversations")
    found = repair.repair(repair.damaged(stored)).withColumnRenamed("conv_id", "_conv")
    every = stored.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    told = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return told.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_ngram_jaccard_join,
        op3_toxicity,
        op4_language_id,
        op5_pii,
        op6_line_dedup,
        op7_benchmark_decontamination,
        op8_warc,
        op9_topk_search,
        op10_packing,
        op11_minhash_near_dedup,
        op12_merkle_manifest,
        op13_conversation_repair,
    )
}
