"""Corpus pipeline: quality classifier, SimHash near-dedup, suffix-array dedup, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the rows that it keeps, with the
columns of documents, and the last one the pieces of packed sequences. Every stage works on all rows that its
predecessor kept.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm import packing, quality, repeats, simhash
from martline.llm.common import Tracked, discard, written
from martline.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the draw keeps, each judged by its own text; those without an id share one draw's noise."""
    drawn = quality.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=docs.columns)
    return drawn.where("kept").select(*[F.col("carried").getField(c).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of 4-word shingle fingerprints within 4 bits: the one with the smallest id. Texts count, not ids: a row
    without an id, or with one that another text has too, goes only if it is a near copy."""
    return simhash.one_of_each(docs, shingle=4, radius=4)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that start earlier; letters are kept whole."""
    others = [c for c in docs.columns if c != "text"]
    out = repeats.remove_repeats(docs, length=100, text="letters", carry=others)
    out = out.select(F.col("kept").cast("string").alias("text"), *[F.col("carried").getField(c).alias(c) for c in others])
    if "n_chars" in others:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece. Workers remember fewer words than by default, as those of the
    stages before may still be there."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), with_ids=False, keep_words=150_000).drop("ids")


_SCRATCH: dict[str, Tracked] = {}


def _tidy(stage):  # noqa: ANN001, ANN202
    """A stage that first deletes what earlier ones left in the scratch folder; a table that its own docs still read stays."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        scratch = _SCRATCH.setdefault(spark.sparkContext.applicationId, Tracked())
        scratch.clear(spark, docs)
        with scratch:
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [("quality classifier", _tidy(keep_good)), ("SimHash near-dedup", _tidy(drop_near_copies)),
          ("suffix-array dedup", _tidy(drop_repeats)), ("packing", _tidy(pack))]

#: The stages need tokenizers, hashes and trained models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(spark, before)  # nothing but tables of the scratch folder
    return STAGES[-1][1](spark, docs, sf_dir)
