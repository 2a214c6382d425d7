"""The training-data pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
returns a frame; ``run`` writes it as Parquet to the shared folder and hands the reread rows
to the next stage, so no stage recomputes another and a lost executor costs one stage's
tasks at most. All stages but the last return the columns of ``documents``.

1. quality classifier: rejected documents go;
2. exact dedup: of equal texts the row with the largest id stays;
3. SimHash near-dedup: one document of each group stays (the smallest id);
4. substring dedup: later copies of repeated passages are cut from the texts;
5. packing: token pieces with their sequence and offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickmart.llm import exact_dedup, packing, quality_classifier, simhash, substring_dedup
from clickmart.llm.common import stored
from clickmart.session import clear_scratch, scratch_mark

#: Learned weights, iterated components and tokenizer files are beyond SQL; see the tests.
ORACLE_SQL = None


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, radius=3)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_repeats(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenize(docs)).select(
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_classifier", keep_good_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; an earlier run's scratch folders are the caller's to
    clear, those of this run's stages go as soon as their rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        mark = scratch_mark(spark)
        done = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear_scratch(spark, mark, keep_last=True)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
