"""A corpus from raw documents: filter, deduplicate, redact, mix, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet to the shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import bpe, minhash, mixing, secrets, toxicity
from seriesloom.llm.text import read_documents, write_table

MAX_REPEAT = 2.0


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the grammar, learned from the labels, scores 0.7 or more."""
    grammar = toxicity.train_grammar(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, grammar)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return minhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts by a mark; every document stays."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources, none more than twice as often as those of the largest; none goes.

    Rows come in training order: by pass, permuted block and place in the block.
    """
    return mixing.in_order(mixing.mix(docs, max_repeat=MAX_REPEAT))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, their digests, and the place of the document in the mix.

    The mix was written in order, so (``file``, ``place``) of a row, its file and its
    number there, order the corpus.  Documents that come from no file have nulls.
    """
    try:
        placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))
    except AnalysisException:  # not read from files
        placed = docs.select("doc_id", "text", F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("place"))
    return bpe.encode(placed, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True, keep=("file", "place"))


STAGES = [("toxicity", toxic), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("mixing", mix), ("bpe", tokenise)]

#: Learned scores, MinHash and BPE are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
