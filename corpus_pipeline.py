"""A training corpus from raw documents: quality, near duplicates, benchmark decontamination, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a frame that `run` writes as Parquet and reads again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakekit.llm import common
from lakekit.llm.common import fresh, materialize, read
from lakekit.llm.decontaminate import remove_contaminated
from lakekit.llm.mixing import mix_sources
from lakekit.llm.ngram_jaccard import jaccard_components
from lakekit.llm.quality_classifier import keep_quality
from lakekit.llm.sharding import assign_shards

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_before: list[str] = []


def _stage(fn):
    """Drops what the previous stage had in the scratch folder: its result is stored by now."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release(spark, _before)
        own = len(common.scratch)
        out = fn(spark, docs, sf_dir)
        _before.extend(common.scratch[own:])
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, does not reject."""
    return keep_quality(docs, read(spark, sf_dir, "labels"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 5-word shingles at 80 % connect: that with the smallest id, ids before null.

    A document is an id with a text (told apart by a 64-bit hash of both), so unrelated texts under one id, or without one, all stay;
    of rows that repeat both, one stays. Texts without words are documents like others, and link with nothing.
    """
    node, first = fresh(docs, "node", "first")
    key = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull())
    links = jaccard_components(docs.select(key.alias("doc_id"), "text"), shingle_words=5, percent=80)
    ids = docs.select(key.alias("_node"), F.col("doc_id").cast("long").alias("_id"))
    # Narrow rows: ids only. Nulls are the largest, ties go to the smaller hash.
    least = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_node")).alias("least")
    kept = links.distinct().join(ids.distinct(), F.col("doc_id") == F.col("_node")).groupBy("component_id").agg(least)
    kept = kept.select(F.col("least._node").alias(node))
    ties = F.row_number().over(Window.partitionBy(node).orderBy(*[F.col(f"`{c}`") for c in docs.columns]))
    one = docs.withColumn(node, key).join(kept, node, "left_semi").withColumn(first, ties).where(F.col(first) == 1)
    return one.select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than 5 % of the words."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions 3, 1, 2, together 150 % of the words: a row for each time that a document, or blocks of it, is taken."""
    mixed = mix_sources(docs)
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else mixed


@_stage
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their shard."""
    return assign_shards(docs, size=F.octet_length("text"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL cannot express the classifier, connected components or seeded blocks; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
