"""A training corpus from ``documents``: the stages in order, each a DataFrame in and a DataFrame out.

``run`` applies them to the table.  All stages but the last return the columns of their input, whatever they are called.
What a stage returns is lazy and may be read at any time: its staged tables stay until ``session.release_staging``.

Null and empty texts fail the quality rules and go there; very long texts are treated whole; repeated rows and equal texts
fall to the near-duplicate stage; rows without an id are nobody's copies; an empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import dart_minhash, decontaminate, mixing, quality_rules, token_store
from ridelake.llm.queries import mix_levels, mix_weights, table, tokenizer_path
from ridelake.llm.workers import share_code
from ridelake.session import staging_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host does."""
    return quality_rules.keep_good(docs)


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    share_code(spark)
    return dart_minhash.keep_one(docs, weighted=True)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat benchmark items; documents that are mostly such passages go."""
    items = table(spark, sf_dir, "benchmark")
    return decontaminate.clean_documents(docs, items)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, each at most once."""
    drawn = mixing.mix(docs, budget_share=0.9, levels=mix_levels(), weights=mix_weights(), tokens=mixing.token_count("text"), seed=17, max_epochs=1)
    return drawn.select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A binary token store of the corpus, and one row per document read back from it."""
    share_code(spark)
    path = staging_path(spark, "corpus-tokens")
    token_store.write_store(docs, path, tokenizer_path())
    return token_store.read_store(spark, path)


STAGES = [("quality", quality), ("near_deduplicated", near_deduplicated), ("decontaminated", decontaminated), ("mixed", mixed), ("token_ids", token_ids)]

#: The near-duplicate stage and the binary output have no SQL.  The tests hold the near-duplicate stage against all pairs and
#: the others against plain versions of their decisions, on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder and read again, as separate jobs would."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
