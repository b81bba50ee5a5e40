"""Text measures of acts, growth between versions and fragmentation of amendments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import END_VERSION, START_VERSION
from ..functions import texts
from .coverage import pivot_unique
from .joins import attach


def text_metrics(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Characters, words, sentences, letters, Gulpease, its band and norm references, row by row."""
    counted = df.select(
        *keep,
        texts.char_count(text).alias("n_caratteri"),
        texts.words(text).alias("n_parole"),
        texts.sentences(text).alias("n_frasi"),
        texts.letters(text).alias("n_lettere"),
        texts.norm_references(text).alias("n_riferimenti_normativi"),
    )
    score = texts.gulpease(F.col("n_lettere"), F.col("n_parole"), F.col("n_frasi"))
    return counted.withColumn("gulpease", score).withColumn("fascia", texts.gulpease_band("gulpease"))


def article_sizes(articles: DataFrame, act: str, text: str, paragraphs: str) -> DataFrame:
    """Articles, paragraphs and mean article length of each act."""
    return articles.groupBy(act).agg(
        F.count("*").alias("n_articoli"),
        F.sum(F.coalesce(F.size(paragraphs), F.lit(0))).cast("bigint").alias("n_commi"),
        F.avg(texts.char_count(text)).alias("lunghezza_media_articolo"),
    )


def act_complexity(articles: DataFrame, act: str, text: str, paragraphs: str) -> DataFrame:
    """Complexity of whole acts from their articles.

    Counts add up over articles, so the act is never put together as one text.
    """
    per_article = text_metrics(articles, text, [act, F.coalesce(F.size(paragraphs), F.lit(0)).alias("__commi")])
    sums = [F.sum(c).alias(c) for c in ("n_caratteri", "n_parole", "n_frasi", "n_lettere", "n_riferimenti_normativi")]
    out = per_article.groupBy(act).agg(
        *sums,
        F.count("*").alias("n_articoli"),
        F.sum("__commi").cast("bigint").alias("n_commi"),
        F.avg("n_caratteri").alias("lunghezza_media_articolo"),
    )
    score = texts.gulpease(F.col("n_lettere"), F.col("n_parole"), F.col("n_frasi"))
    return out.withColumn("gulpease", score).withColumn("fascia", texts.gulpease_band("gulpease"))


def growth(articles: DataFrame, start: str = START_VERSION, end: str = END_VERSION) -> DataFrame:
    """Words of each article in two versions and the difference; a missing version counts 0."""
    counted = articles.select(
        "atto_id",
        texts.article_number("numero_articolo").alias("num_clean"),
        "versione",
        texts.word_count("testo_integrale").alias("word_count"),
    )
    wide = pivot_unique(counted, ["atto_id", "num_clean"], "versione", [start, end], "word_count")
    zero = F.lit(0)
    return wide.withColumn("delta_words", F.coalesce(end, zero) - F.coalesce(start, zero))


def fragmentation(amendments: DataFrame, proponents: DataFrame, by_act: bool = False) -> DataFrame:
    """Distinct amendments and distinct groups per target article; NULL groups do not count.

    Proponents are folded to distinct (amendment, group) pairs before the join.
    """
    keys = ["atto_id", "num_clean"] if by_act else ["num_clean"]
    groups = proponents.select("emendamento_id", "proponente_gruppo").distinct()
    targets = amendments.select("atto_id", "emendamento_id", F.col("articolo_target").alias("num_clean"))
    return (
        targets.join(groups, "emendamento_id", "left")
        .groupBy(*keys)
        .agg(
            F.countDistinct("emendamento_id").alias("num_emendamenti"),
            F.countDistinct("proponente_gruppo").alias("num_gruppi_coinvolti"),
        )
    )


def growth_vs_fragmentation(articles: DataFrame, amendments: DataFrame, proponents: DataFrame, by_act: bool = False) -> DataFrame:
    """Growth of each article next to the fragmentation of the amendments aimed at it.

    The default joins on the article number alone and so mixes acts, as the published
    table does; ``by_act=True`` also asks for the same act.
    """
    keys = ["atto_id", "num_clean"] if by_act else ["num_clean"]
    return attach(growth(articles), fragmentation(amendments, proponents, by_act), keys)


OUTCOME = r"(?i)l'emendamento\s+(\d+(?:\.\d+)*)\s+(?:è|e'|viene|risulta)\s+(approvato|respinto|ritirato)"


def outcomes(minutes: DataFrame, key: str, text: str, pattern: str = OUTCOME) -> DataFrame:
    """Amendment numbers and outcomes named in narrative minutes, one row each."""
    hits = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    return minutes.select(key, F.explode(hits).alias("__hit")).select(
        key,
        F.regexp_extract("__hit", pattern, 1).alias("numero_emendamento"),
        F.lower(F.regexp_extract("__hit", pattern, 2)).alias("esito"),
    )


def duplicate_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Copies of each text, up to white space: size of the group and its smallest key."""
    return (
        df.groupBy(texts.fingerprint(text).alias("impronta"))
        .agg(F.count("*").alias("n_copie"), F.min(key).alias("capofila"))
        .filter("n_copie > 1")
    )
