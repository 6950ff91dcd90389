"""From raw documents to token ids: quality rules, toxicity, near-duplicates, decontamination, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import decontaminate, neardup, pieces, quality, toxicity
from candlewick.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their hosts' boilerplate lines."""
    return quality.clean(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a model of the labelled ones among them."""
    return toxicity.drop_toxic(docs, toxicity.train_on(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that op10 links: fingerprints of three-word shingles with three or fewer differing bits."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return pieces.encode_texts(docs, pieces.load_vocabulary())


#: (name, function) in order; each function takes (spark, docs, sf_dir), and all but the last return the columns of ``docs``.
STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", encoding),
]

#: The stages learn models and pass texts through hashes that SQL does not have; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each stage's rows are written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
