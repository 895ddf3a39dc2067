"""The corpus pipeline: quality rules, toxicity, near duplicates, source mix, packing.

`STAGES` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet in the shared folder and read again as the next one's documents. All but the last return the columns of documents.
Each stage's rules for nulls, empty and repeated rows are those of its operator; an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationcast.llm.jaccard import one_of_each
from stationcast.llm.mixing import mixed_documents
from stationcast.llm.packing import pack
from stationcast.llm.quality import kept_documents
from stationcast.llm.support import written
from stationcast.llm.toxicity import clean_documents

#: Near duplicates of the pipeline: five-word shingles, a similarity of 0.8 or more.
SHINGLE_WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the cut-offs of their language and source; the others go."""
    return kept_documents(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic by a model of the labels of the documents that are still there."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return one_of_each(docs, shingle_words=SHINGLE_WORDS, percent=PERCENT)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by target weights: documents whole, repeated, in part at the ends of a run of blocks, or not at all."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens. Repeated documents are packed one by one."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules), ("toxicity", toxicity), ("near_duplicates", near_duplicates),
    ("source_mix", source_mix), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Learned scores and tokenizer ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
