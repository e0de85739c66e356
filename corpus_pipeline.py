"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

1. quality classifier: documents that it rejects go;
2. line dedup: recurring line templates go, every document stays;
3. n-gram Jaccard join: of each group of near duplicates the least doc_id stays;
4. benchmark decontamination: documents that leak a benchmark item go;
5. mixing: a row for each time that the mix takes a document; one it doesn't take goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramspan.llm import decontaminate, jaccard, lines, mixing, quality
from gramspan.llm.common import stored
from gramspan.sources import read_table

# Near duplicates: word 5-grams, similarity of 0.8 or more.
NEAR = jaccard.Similarity(words=5, percent=80)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    table = stored(quality.feature_table(docs), "pipeline-features")
    model = quality.fit(table, read_table(spark, sf_dir, "labels"))
    return docs.filter(model.score_text(F.col("text")) >= 0.5)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.drop_recurring_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(docs, NEAR).filter("component_id != doc_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources", mix),
]

# A fitted classifier and template trees are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
