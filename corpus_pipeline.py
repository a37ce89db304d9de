"""Corpus pipeline: documents -> toxicity -> language -> near-duplicates -> decontamination -> packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import decontaminate, language_hd, packing, simhash_tiles, toxicity
from rivulet.llm.batches import crc_part, save_and_reread, table
from rivulet.llm.queries import toxicity_lexicon


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go; the lexicon is learned from the labelled documents of this stage.

    Null and empty texts stay; repeated rows are judged each; an empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity_lexicon(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those further from every language learned than their length explains.

    Null and empty texts go; equal cosines go to the first language by name; repeated rows are judged each; an empty table
    stays empty.
    """
    return language_hd.drop_unidentified(docs, language_hd.learn(docs, where=crc_part(F.col("doc_id"), 4) != 2))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays: of the least doc_id (null last), then of the least text hash.

    Null and empty texts are one component; rows that share an id or have none are judged each by its text; of equal rows one
    stays; an empty table stays empty.
    """
    return simhash_tiles.drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go.

    Null and empty texts stay; benchmark rows with a null id or text are passed over; repeated rows are judged each; an empty
    table stays empty.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their sequences.

    Null texts are empty; repeated rows and rows without id are packed each; an empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [("toxicity", toxic), ("language_id", language), ("simhash_near_dedup", near_duplicates),
          ("decontamination", benchmark_passages), ("packing", packed)]

#: Learned models, 64-bit hashes and packing have no SQL form; tests hold run() against the stages run by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save_and_reread(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
