"""From raw documents to packed training sequences.

Each stage takes what the one before kept, all of it, and its decisions take
effect. ``run`` writes every stage's result to the shared folder and reads it
again, so a lost executor costs at most the tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.minhash import drop_near_copies
from termloom.llm.mixing import five_two_one, mixed_documents, plan_mix
from termloom.llm.packing import pack_documents
from termloom.llm.pii import redact
from termloom.llm.quality import quality_scores, train_quality
from termloom.plans.workspace import Workspace

# Words the mix takes, as a share of all words of its documents.
MIX_FACTOR = 1.5
MOST_REPEATS = 2.0
SCORE = "__quality"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by the labels, does not reject."""
    model = train_quality(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(docs, model, SCORE).filter(F.col(SCORE) >= 0.5).drop(SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every confirmed span of personal data replaced by its kind."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per draw of the mix, shard after shard."""
    return mixed_documents(docs, plan_mix(docs, five_two_one, MIX_FACTOR, MOST_REPEATS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 1,024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near copies", near_copies),
    ("personal data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

# Models, hashes and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    workspace = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = workspace.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
