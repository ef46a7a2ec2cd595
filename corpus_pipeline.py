"""The corpus pipeline: toxic and low-quality documents go, near duplicates are reduced to one, test passages go, the rest is encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import bpe, decontaminate, near_dup, quality, toxicity
from patronage.llm.common import stored
from patronage.llm.queries import BYTE_BPE, table, vocabulary_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine does not predict as toxic; null and empty texts stay here."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.scorer(machine)(F.col("text")) < 0.5)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content; null and empty texts go."""
    field = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.judge(field)(F.col("text"))["kept"])


#: Near duplicates of the corpus, by the general rule for word shingles.
NEAR = near_dup.Settings(percent=80)


def keyed(docs: DataFrame) -> DataFrame:
    """`docs` with `_key`, which names a text: the doc_id, but for rows without one and all but one text of those that share one.

    Such texts come once each, under numbers beyond all ids. Only ids are shuffled where there are none.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if ids.isEmpty():
        return docs.withColumn("_key", F.col("doc_id"))
    shared = ids.select(F.col("doc_id").alias("_id"))
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    plain = docs.join(shared, same, "left_anti").withColumn("_key", F.col("doc_id").cast("decimal(38,0)"))
    last = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("decimal(38,0)")).first()[0]
    odd = stored(docs.join(shared, same, "left_semi").dropDuplicates(["doc_id", "text"]).withColumn("_key", F.monotonically_increasing_id()), "odd-rows")
    first = odd.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("_key").alias("_key")).select("_key", F.lit(True).alias("_first"))
    number = F.when(F.col("_first"), F.col("doc_id")).otherwise((F.lit(last) + 1 + F.col("_key"))).cast("decimal(38,0)")
    return plain.unionByName(odd.join(first, "_key", "left").withColumn("_key", number).drop("_first"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity of 0.8 or more): that of least doc_id, rows without one last.

    Equal rows are one. Different texts of one doc_id are documents of their own, and so are rows without a doc_id.
    """
    named = keyed(docs)
    texts = named.select(F.col("_key").alias("doc_id"), "text")
    kept = near_dup.near_duplicates(texts, NEAR).filter("kept").select(F.col("doc_id").alias("_key"))
    return named.join(kept, "_key", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    how = decontaminate.Settings()
    blocks = decontaminate.seed_blocks(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"), how)
    return docs.filter(decontaminate.best_score(F.col("text"), blocks, how) < how.least_score)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and whether the ids decode to the very text."""
    kept = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    done = bpe.encode_documents(kept, vocabulary_file(BYTE_BPE), ("doc_id", "text"), decode_too=True)
    return done.select("doc_id", "ids", "n_tokens", (F.col("decoded") == F.col("text")).alias("round_trip"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Trained models and BPE are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
