"""A corpus from documents: toxicity, line dedup, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept. All but the last return the columns of documents.

Defined results. Null and empty texts pass every stage but are no near duplicates of
anything. Rows that repeat a doc_id stay or go together: the line stage keeps a line
in all rows of its keeper, the near-duplicate stage takes the largest of their texts.
Of near duplicates the smallest doc_id stays; a null doc_id is nobody's duplicate. Other
columns are carried along; those that a stage adds by the same name hide them until the
stage's end only. Empty tables of documents, labels or items give empty or unfiltered
results. Texts of any length are read whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from sievemark.llm.stage import checkpoint_folder
from sievemark.session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.passages(docs, model).where("score < 0.7").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines in five documents or more stay in one; n_chars follows the text."""
    ship(spark)
    out = line_dedup.drop_lines(docs, min_chars=40, min_docs=5).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 over five-word shingles, the one with the smallest doc_id stays."""
    ship(spark)
    groups = ngram_join.near_duplicates(docs, k=5, num=80, den=100).select("doc_id", "component_id").distinct()
    gone = groups.where("component_id != doc_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go."""
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"), window=10, shingle=5)
    return found.where("n_hit = 0").select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's bucket, batch and slot."""
    ship(spark)
    return packing.report(docs, buckets=8, budget=65_536)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", one_of_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: The toxicity model is no SQL: a test compares the run with a brute-force version of the other stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
