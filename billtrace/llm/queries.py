"""The corpus queries, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    exact_dedup,
    importance,
    language_id,
    packing,
    parity_join,
    permutation_index,
    secret_scan,
    sharding,
    suffix_dedup,
    toxicity,
    vector_codes,
    warc,
)
from .common import ready, sample_per_class, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = lambda spark, sf_dir: function(ready(spark), sf_dir.rstrip("/"))
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_tokenizer() -> tuple[str, str]:
    """Path of the vocabulary, and the pattern that splits a text before its merges."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def fold(key: str = "doc_id") -> Column:
    """Fold of a row; rows of fold 1 are held out. A NULL key has fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3, F.lit(0))


@_query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret of every document: counts of the base kinds, their digest, and all spans."""
    found = _table(spark, sf_dir, "documents").select("doc_id", secret_scan.secrets("text").alias("s"))
    count = lambda *kinds: F.size(F.filter("s", lambda x: x["kind"].isin(*kinds))).cast("long")
    base = F.filter("s", lambda x: x["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("s")).alias("spans"),
        (F.size("s") - count(*secret_scan.BASE_KINDS)).cast("long").alias("n_confirmed"),
    )


@_query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that lie in a repeated string of 400 bytes."""
    found = suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", (F.col("n_removed") > 0).alias("repeats"))


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens."""
    parts = packing.pieces(_table(spark, sf_dir, "documents"), *public_tokenizer())
    return packing.pack(parts).withColumnRenamed("id", "doc_id")


@_query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are at least 0.9 similar."""
    found = parity_join.similarity_components(_table(spark, sf_dir, "documents"), n=3, num=90, den=100)
    return found.withColumnRenamed("id", "doc_id")


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in an occurrence of a benchmark window."""
    found = decontamination.with_hits(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        "hits.contaminated",
    )


@_query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's group of equal texts and the row that stays."""
    groups = exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL["op6_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (
  SELECT doc_id, sha256(norm) AS text_sha256, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""


@_query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of near-equal bytes."""
    placed = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), shards=16)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC transactions, read back and assembled."""
    pages = _table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_captures(pages, path)
    captures = warc.originals(warc.assemble(warc.read_records(spark, path, payload=False)))
    kind = pages.schema["page_id"].dataType
    return captures.select(
        F.col("page").cast(kind).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


SQL["op8_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
), r AS (
  SELECT *, payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM f
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to
FROM r
"""


def toxicity_network(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> toxicity.Network:
    """A network trained on labelled rows outside fold 1: the labels are sampled first, then their texts joined."""
    known = sample_per_class(labels.filter(fold() != 1).select(F.col("doc_id").alias("__labelled"), "toxic"), "toxic", "__labelled", toxicity.DOCS_PER_CLASS)
    return toxicity.train(documents.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__labelled")))


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    score = toxicity.scorer(spark, toxicity_network(spark, documents, _table(spark, sf_dir, "labels")))
    scored = documents.select("doc_id", (fold() == 1).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    guess = language_id.identifier(spark, language_id.train(documents.filter(fold() != 1)))
    found = documents.select("doc_id", (fold() == 1).alias("held_out"), guess("text").alias("g"))
    return found.select("doc_id", "held_out", F.col("g.lang").alias("lang_pred"), "g.score")


@_query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors after six rounds over codebooks of 16 entries."""
    return vector_codes.compress(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def _rounds_sql(parts: int = 8, size: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain rounds, one after the other: every part against every entry of its codebook."""
    steps = [
        f"""k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * {size} + 1 : part * {size} + {size}] AS x FROM k, range({parts}) r(part)
), b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS c FROM p
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {entries}
)"""
    ]
    away = " + ".join(f"(x[{j}] - c[{j}]) * (x[{j}] - c[{j}])" for j in range(1, size + 1))
    total = lambda j: f"CAST(sum(x[{j}]) AS BIGINT)"
    mean = ", ".join(f"({total(j)} - ((({total(j)} % count(*)) + count(*)) % count(*))) // count(*)" for j in range(1, size + 1))
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, label, part, x, min(({away}) * {entries} + e) AS m FROM p JOIN b{r} USING (part) GROUP BY ALL)")
        if r < rounds:
            steps.append(
                f"b{r + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(n.c, b.c) AS c FROM b{r} b LEFT JOIN "
                f"(SELECT part, m % {entries} AS e, [{mean}] AS c FROM a{r} GROUP BY part, m % {entries}) n ON n.part = b.part AND n.e = b.e)"
            )
    steps.append(
        f"""coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', m % {entries}), '' ORDER BY part) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label
)"""
    )
    return (
        f"WITH {', '.join(steps)}\n"
        "SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,\n"
        f"       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) FROM b{rounds}) AS codebooks_sha256\nFROM coded"
    )


SQL["op11_vector_codes"] = _rounds_sql()


@_query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed by their likeness to the benchmark; a tenth of those with 20 words drawn."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# A CRC-32 over the bytes of each distinct word; its table of 256 entries follows from the polynomial.
SQL["op12_importance_resampling"] = r"""
WITH bits AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc
  FROM range(256) r(b)
), d AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), t AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark
), w AS (
  SELECT row_no, unnest(words) AS word FROM d
), known AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM w UNION SELECT word FROM t)
), hashed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[i * 2 + 1 : i * 2 + 2] AS BIGINT))),
         lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]))) % 10000 AS bucket
  FROM known, bits
), s AS (
  SELECT bucket, count(*) AS n FROM w JOIN hashed USING (word) GROUP BY bucket
), g AS (
  SELECT bucket, count(*) AS n FROM t JOIN hashed USING (word) GROUP BY bucket
), gain AS (
  SELECT b AS bucket, CAST(floor(1000 * ln((coalesce(g.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM w) + 10000) / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM t) + 10000)))) AS BIGINT) AS gain
  FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN g ON g.bucket = b
), weight AS (
  SELECT row_no, CAST(sum(gain) AS BIGINT) AS total, count(*) AS n FROM w JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY row_no
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce((total - ((total % n + n) % n)) // n, 0) AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS noise
  FROM d LEFT JOIN weight USING (row_no)
), ranked AS (
  SELECT doc_id, n_features, weight, weight + noise AS score,
         CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) END AS place
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(place) * 10 // 100 FROM ranked) THEN place END AS rank FROM ranked
"""


@_query
def op13_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found of every twentieth vector."""
    found = permutation_index.nearest(_table(spark, sf_dir, "embeddings"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
