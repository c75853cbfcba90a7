"""A corpus pipeline of five stages, each calling one text operator.

Every stage takes (spark, docs, sf_dir); docs are the rows that the stage before
kept, with the columns of documents. Each result is written as Parquet and read again
as the next one's docs. The last stage gives the pieces of packed sequences.

In every stage: an empty table gives an empty one; extra columns pass through, and names
that clash with those of results do no harm; null ids lose no document. Null and empty
texts, and repeated rows, are treated as each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import cleared, staged, unstage
from tidemark.llm.decontaminate import keep_clean
from tidemark.llm.packing import pack
from tidemark.llm.quality_rules import keep_good
from tidemark.llm.simhash import keep_distinct
from tidemark.llm.toxicity import keep_civil, train


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and the word rules keep. Null and empty texts go;
    repeated rows stay or go together."""
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.3, by a model of the labelled ones among them. Null
    and empty texts have the score of no words; repeated rows stay or go together; without
    toxic labels nothing goes."""
    return keep_civil(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates: texts whose
    five-word shingles have a Jaccard similarity of 0.8 or more. Texts without words, null
    ones among them, are one group; of repeated rows one stays; a null id comes last."""
    return keep_distinct(docs, size=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item. Null and empty texts stay;
    an empty benchmark takes nothing away."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 ids. Null and empty texts are the
    end id alone; repeated rows are packed as often as they stand."""
    return pack(docs, with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents. What a stage staged on its way goes once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with cleared(spark) as made:
            kept = staged(stage(spark, docs, sf_dir), name)
            made.remove(kept.staged_at)
        if hasattr(docs, "staged_at"):
            unstage(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)


#: Compression ratios, a trained model and token ids are beyond SQL; the tests hold the
#: stages against brute force.
ORACLE_SQL = None
