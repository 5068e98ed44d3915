"""Every operator of this subpackage as a query over the standard tables, with SQL where it can speak."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, clustering, katz, minhash, mixing, neighbours, quality, secrets, simhash, suffixdedup, superkmers, toxicity
from .text import read_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Where the vocabularies lie; parameters of the operators.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train_grammar(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query("op2_minhash")
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest doc_id of its class of near-duplicates."""
    return minhash.near_duplicates(read_documents(spark, sf_dir)).drop("class_key")


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(read_documents(spark, sf_dir))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(read_documents(spark, sf_dir))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_documents(spark, sf_dir), TOKENIZER)


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_documents(spark, sf_dir))


@query("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.remove_repeats(read_documents(spark, sf_dir))


@query("op8_katz")
def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(read_documents(spark, sf_dir))


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of whole documents in which no source passes more than twice as often as another."""
    mixed = mixing.mix(read_documents(spark, sf_dir).select("doc_id", "text", "source"), max_repeat=2.0)
    return mixed.select("row.doc_id", "row.source", "n_tokens", "epoch", "block", "block_order", "doc_order")


@query("op10_neighbours")
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _clustering_sql(rounds: int = 10, k: int = 8) -> str:
    """The rounds written out: distances to all centroids, the nearest, floors of the means."""
    nearest = """a{i} AS MATERIALIZED (SELECT v.*, c.cluster, c.x AS centroid,
      list_sum(list_transform(range(1, 65), lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j])))::BIGINT AS distance
      FROM v CROSS JOIN c{i} c QUALIFY row_number() OVER (PARTITION BY v.row_id ORDER BY distance, c.cluster) = 1)"""
    update = """c{j} AS MATERIALIZED (SELECT c.cluster, coalesce(s.x, c.x) AS x FROM c{i} c LEFT JOIN (
      SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS x FROM (
        SELECT cluster, place, sum(value)::BIGINT AS s, count(*) AS n FROM (
          SELECT cluster, unnest(x) AS value, unnest(range(64)) AS place FROM a{i}) GROUP BY cluster, place) GROUP BY cluster) s USING (cluster))"""
    steps = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id,
      list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)"""]
    steps.append(f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS cluster, x FROM v
      QUALIFY cluster < {k})""")
    for i in range(rounds):
        steps += [nearest.format(i=i), update.format(i=i, j=i + 1)]
    steps.append(nearest.format(i=rounds))
    return "WITH " + ",\n".join(steps) + f"""
    SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
      (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(centroid, ',')) AS centroid_sha256 FROM a{rounds}"""


@query("op11_clusters", _clustering_sql())
def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustering.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("centroid_sha256", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)).drop("centroid")


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_counts(read_documents(spark, sf_dir), TOKENIZER, PIECES)


@query("op13_simhash")
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, sf_dir))
