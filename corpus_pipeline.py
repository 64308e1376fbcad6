"""Corpus pipeline: language ID, n-gram Jaccard join, benchmark decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; ``run``
writes every stage's rows as Parquet in the shared scratch folder and reads
them back as the next stage's documents, so a lost executor costs no more than
the stage it was in. All stages but the last return the columns of the
documents; columns they do not know pass through, and null ids, null or empty
texts, repeated rows and empty tables are as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.llm import langid, mixing
from skytide.llm.decontaminate import find_contamination
from skytide.llm.jaccard_join import jaccard_components
from skytide.llm.queries import table
from skytide.llm.shards import shard_by_bytes
from skytide.session import broadcast_if_small, ship_package, stage, staging_scope

LEAST_SCORE = 0.5


def _rows(docs: DataFrame) -> DataFrame:
    """Each document whole as ``row``, beside what the stages decide by, so that no
    column of the documents can clash with theirs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(whole, F.col("doc_id"), F.col("source"), F.col("text"), F.xxhash64(text).alias("k1"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a score of at least ``LEAST_SCORE``;
    null texts and texts without a letter go."""
    ship_package(spark)
    judged = langid.predict(_rows(docs).select("row", "text"), langid.fit(docs))
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id
    (null ids last, then by the hash of the text; of equal ids and texts any one).
    Documents without words have no copies and stay."""
    ship_package(spark)
    with staging_scope():
        classes = stage(jaccard_components(docs).where("n_shingles > 0").select("doc_id", "k1", "root"), "classes")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1")).alias("first")
        stays = classes.groupBy("root").agg(first)
        same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k1") == F.col("first.k1"))
        goes = stage(classes.join(stays, "root").where(~same).select("doc_id", "k1").distinct(), "goes", keep=True)
        repeated = classes.groupBy("doc_id", "k1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        repeated = stage(repeated, "repeated", keep=True)
    # Few enough, the keys go to the documents; else whole documents are shuffled.
    goes = broadcast_if_small(goes)
    rows = _rows(docs)
    kept = rows.join(goes, _same_document(rows, goes), "left_anti")
    if repeated.isEmpty():
        return kept.select("row.*")
    several = kept.join(repeated, _same_document(kept, repeated), "left_semi")
    one = several.groupBy("doc_id", "k1").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.join(repeated, _same_document(kept, repeated), "left_anti").select("row.*").unionByName(one.select("row.*"))


def _same_document(rows: DataFrame, keys: DataFrame):
    return rows["doc_id"].eqNullSafe(keys["doc_id"]) & (rows["k1"] == keys["k1"])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark text go."""
    with staging_scope():
        hit = find_contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("k1").distinct()
        hit = stage(hit, "contaminated", keep=True)
    return _rows(docs).join(hit, "k1", "left_anti").select("row.*")


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated rows, or none."""
    ship_package(spark)
    with staging_scope():
        planned = mixing.plan(stage(mixing.apart(stage(mixing.measured(docs), "measured")), "apart"))
    if not planned:
        return docs
    rows = _rows(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.select(
        "row", "doc_id", F.col("source").cast("string").alias("source"), mixing.word_count(F.col("text")).alias("size"),
        F.lit(1.0).alias("base"), mixing.hash_of(F.col("doc_id"), text).alias("u"),
    )
    taken = mixing.with_copies(mixing.apart(rows), planned).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and place of every document of the mix, with its source and language."""
    ship_package(spark)
    return shard_by_bytes(docs, carry=tuple(c for c in ("source", "lang") if c in docs.columns))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing", mixing_to_weights),
    ("sharding", sharding),
]

# No SQL: the stages train a model, follow links and solve for rates; the tests
# compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
