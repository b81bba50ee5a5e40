"""The corpus pipeline: raw documents to packed training sequences.

Five stages, each over all that the one before kept: toxic documents go, then exact copies, then all
but one of each group of near copies, then documents contaminated by the benchmark; what is left is
tokenised and packed. Rows without a doc_id take part; so do rows that repeat an id, each for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billtrace.llm import decontamination, exact_dedup, packing, parity_join, queries, toxicity
from billtrace.llm.common import ready, staged

SHINGLE_WORDS = 5
SIMILARITY = (80, 100)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of the toxicity network."""
    ready(spark)
    score = toxicity.scorer(spark, queries.toxicity_network(spark, docs, _table(spark, sf_dir, "labels")))
    mark = _free(docs, "__toxicity")
    return docs.withColumn(mark, score(F.col("text"))).filter(F.col(mark) < toxicity.THRESHOLD).drop(mark)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the one with the largest id."""
    ready(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by similar sets of five-word shingles, the one with the smallest id.

    A row is told by its id and text, so rows that share an id are judged one by one. Rows without an
    id come after all others; of equal ids the smaller hash of the text stays.
    """
    ready(spark)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    found = parity_join.similarity_components(docs.select(row.alias("row"), "text"), "row", n=SHINGLE_WORDS, num=SIMILARITY[0], den=SIMILARITY[1])
    gone = found.filter(F.col("id") != F.col("component_id")).select(F.col("id.id").alias("__gone"), F.col("id.hash").alias("__hash")).distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("g.__gone")) & (F.xxhash64("d.text") == F.col("g.__hash"))
    return docs.alias("d").join(staged(gone, "gone").alias("g"), same, "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without hits, or of which less than a twentieth of the words is hit."""
    ready(spark)
    hits = _free(docs, "__hits")
    marked = decontamination.with_hits(docs, _table(spark, sf_dir, "benchmark"), as_col=hits)
    return marked.filter(~F.col(f"{hits}.contaminated")).drop(hits)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 tokens."""
    ready(spark)
    return packing.pack(packing.pieces(docs, *queries.public_tokenizer())).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Trained scores, components and a search for good packings are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
