"""Named queries of this subpackage over whole given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.llm.decontaminate import find_contamination
from skytide.llm.hard_negatives import hard_negatives
from skytide.llm.jaccard_join import jaccard_components
from skytide.llm.langid import identify
from skytide.llm.mixing import mix
from skytide.llm.nn_descent import near_components
from skytide.llm.oracle import ORACLE  # noqa: F401
from skytide.llm.periodic_runs import collapsed_runs, periodic_tail
from skytide.llm.pii import find_personal_data
from skytide.llm.secrets import find_secrets
from skytide.llm.shards import shard_by_bytes
from skytide.llm.suffix_dedup import repeated_spans
from skytide.llm.trie_dedup import text_owners
from skytide.llm.url_filter import judge
from skytide.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    return repeated_spans(table(spark, sf_dir, "documents"))


def op2_langid(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op3_secrets(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return find_secrets(documents, owner="source", repository=F.concat_ws("/", "source", "lang")).drop("found")


def op4_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).drop("source")


def op5_nn_descent(spark, sf_dir):
    return near_components(table(spark, sf_dir, "embeddings"))


def op6_pii(spark, sf_dir):
    return find_personal_data(table(spark, sf_dir, "documents")).drop("found")


def op7_url_filter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages")).drop("reason")


def op8_shards(spark, sf_dir):
    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents")).drop("k1", "root")


def op10_decontaminate(spark, sf_dir):
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "k1")


def op11_periodic_runs(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return collapsed_runs(documents, text=periodic_tail(F.col("doc_id"), F.col("text")))


def op12_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), anchors=F.col("vec_id") % 100 == 0)


def op13_exact_dedup(spark, sf_dir):
    return text_owners(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_langid, op3_secrets, op4_mixing, op5_nn_descent, op6_pii, op7_url_filter, op8_shards,
        op9_jaccard_join, op10_decontaminate, op11_periodic_runs, op12_hard_negatives, op13_exact_dedup,
    )
}
