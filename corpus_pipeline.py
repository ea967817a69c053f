"""Corpus preparation in stages: toxic documents go, then boilerplate lines, near duplicates and benchmark
leaks; what is left is packed into sequences. Each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.boilerplate import drop_shared_lines
from riskloom.llm.decontamination import drop_contaminated
from riskloom.llm.frames import stored
from riskloom.llm.packing import pack_documents
from riskloom.llm.similarity import keep_one_of_each_group
from riskloom.llm.toxicity import drop_toxic, train_toxicity
from riskloom.session import skew_safe

def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model, learned from these documents and the labels, scores below 0.5."""
    labels = skew_safe(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, train_toxicity(docs, labels))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without lines that too many different texts of their source share; n_chars follows the text."""
    cut = drop_shared_lines(docs, "source", "text")
    length = F.when(F.col("dropped_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one of least doc_id."""
    return keep_one_of_each_group(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_boilerplate),
    ("n-gram Jaccard join", without_near_duplicates),
    ("benchmark decontamination", without_leaks),
    ("best-fit packing", packed),
]

# The first stage rests on a fitted model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = skew_safe(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
