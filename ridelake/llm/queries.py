"""The operators as named queries over the whole provided tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import (
    dart_minhash, decontaminate, length_index, line_dedup, mixing, passage_chains, quality_rules, sentence_pieces, suffix_dedup, token_store, toxicity, variants, warc,
)
from ridelake.llm.workers import share_code
from ridelake.session import staging_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_passage_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passage_chains.fuzzy_passages(table(spark, sf_dir, "documents"))
    covered = F.aggregate(
        "passages",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + F.greatest(F.lit(0), p["end"] - F.greatest(p["start"], acc["end"]))).alias("n"), F.greatest(acc["end"], p["end"]).alias("end")),
        lambda acc: acc["n"],
    )
    partners = F.array_sort(F.array_distinct(F.transform("passages", lambda p: p["other"])))
    return found.select(F.col("id").alias("doc_id"), "n_words", F.size("passages").cast("long").alias("n_passages"), covered.alias("n_repeated"), partners.alias("partners"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scores = toxicity.score_documents(docs, model).withColumnRenamed("id", "doc_id")
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = dart_minhash.near_duplicates(table(spark, sf_dir, "documents"), weighted=True)
    return classes.select(F.col("id").alias("doc_id"), "class_id", (F.col("id") == F.col("class_id")).alias("kept"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    """The vocabulary that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_store.read_store(spark, path)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("row.doc_id", *quality_rules.FACTS, "base_failed", "kept")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def mix_levels() -> dict[str, Column]:
    """Levels of the mixing tree.  The documents have no domain: a checksum of the source deals sources into four."""
    domain = F.concat(F.lit("d"), F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(4)).cast("string"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def mix_weights() -> list[Column]:
    return [
        F.when(F.col("domain") == "d0", 4).when(F.col("domain") == "d1", 3).otherwise(2),
        F.when(F.col("lang") == "en", 2).otherwise(3),
        F.lit(1),
    ]


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), budget_share=1.25, levels=mix_levels(), weights=mix_weights(), tokens=mixing.token_count("text"), seed=17, max_epochs=4, carry=["doc_id"])
    return mixed.select("row.doc_id", "domain", "lang", "source", "tokens", "epoch")


def piece_model_path() -> str:
    """The model that the piece query uses."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_model_path()
    coded = sentence_pieces.decode(sentence_pieces.encode(table(spark, sf_dir, "documents"), model), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.spelled_words(table(spark, sf_dir, "documents")))


def op13_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "length-index")
    length_index.build_index(table(spark, sf_dir, "documents"), path)
    found = length_index.search(spark, path, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


_QUERIES: list[Query] = [
    op1_passage_chains, op2_toxicity, op3_decontaminate, op4_dart_minhash, op5_line_dedup, op6_token_store, op7_warc, op8_quality_rules, op9_suffix_dedup, op10_mixing,
    op11_sentence_pieces, op12_variants, op13_length_index,
]


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}
