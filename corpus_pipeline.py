"""A corpus from raw documents to packed sequences, in four stages.

Each stage takes all rows that its predecessor kept and returns rows of the same columns,
the last one packed pieces. Between stages the rows are written as Parquet.

In every stage: an empty table gives an empty result; null ids are rows like others; columns
whose names clash with results are kept as they are by all stages but the last, which reads
doc_id and text only; texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkbrook.llm import langid, neardup, packing, rules
from sparkbrook.scratch import materialize
from sparkbrook.session import ship_package

#: Cosine with the best language below which a document is in none of them.
LEAST_SCORE = 0.1
#: Up to so many ids of dropped documents are broadcast; beyond, the join is shuffled.
BROADCAST_IDS = 1_000_000


def _aside(docs: DataFrame, own: tuple[str, ...]):
    """``docs`` with all columns but ``own`` under names that no operator uses, and the way back."""
    names = {c: c if c in own else f"_column_{i}" for i, c in enumerate(docs.columns)}
    there = docs.select([F.col(f"`{c}`").alias(names[c]) for c in docs.columns])
    return there, lambda df: df.select([F.col(f"`{names[c]}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or the likelihood ratio.

    Null and empty texts fail; repeated rows stay or go together; a ratio that equals the
    threshold stays.
    """
    ship_package(spark)
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    own, back = _aside(docs, ("doc_id", "text"))
    return back(rules.judge(own, trusted, rules.PAIRS).filter("kept"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language.

    Null texts and texts without a letter have none, and without any label no text has;
    repeated rows stay or go together; a score that equals the least stays.
    """
    ship_package(spark)
    profile = langid.Profile()
    names, prototypes = langid.train_prototypes(docs.filter(~langid.held_out()).select("doc_id", "text", "lang"), profile)
    own, back = _aside(docs, ("doc_id", "text"))
    found = langid.identify(own, names, prototypes, profile)
    return back(found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates (five words, 0.8).

    Rows are compared by a number of their own, so rows that share an id, or have none, are
    documents like any other; a null id comes after all others, and of rows that tie the
    first as read stays. Null and empty texts are near nothing and stay.
    """
    ship_package(spark)
    own, back = _aside(docs, ("doc_id", "text"))
    rows = materialize(own.withColumn("_row", F.monotonically_increasing_id()), "rows")
    near = neardup.near_duplicates(rows.select("_row", "text"), id_column="_row").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    near = materialize(near, "near")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    firsts = near.join(rows.select("_row", "doc_id"), "_row").groupBy("_group").agg(F.min(order)["row"].alias("_first"))
    # groups are named by their smallest row; where another row has the smallest id, the two change places
    moved = materialize(firsts.filter("_first <> _group"), "moved")
    others = near.filter("_row <> _group").select("_row").join(moved.select(F.col("_first").alias("_row")), "_row", "left_anti")
    dropped = materialize(others.unionByName(moved.select(F.col("_group").alias("_row"))), "dropped")
    few = dropped.count() <= BROADCAST_IDS
    return back(rows.join(F.broadcast(dropped) if few else dropped, "_row", "left_anti"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens; null texts are their end mark, repeated rows pieces of their own."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Sketches, tokens and trained profiles are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
