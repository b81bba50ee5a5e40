"""Procedure phases, votes with dates, and amendment dates through shared subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .coverage import count_if
from .joins import attach


def phases_of_bills(iters: DataFrame, bills: DataFrame, bill: str) -> DataFrame:
    """Procedure rows with the legislature of their bill."""
    return iters.join(bills.select(bill, "legislatura").distinct(), bill)


def amendment_dates(amendments: DataFrame, votes: DataFrame, sessions: DataFrame) -> DataFrame:
    """Earliest session date of a vote on the amendment's subject.

    Votes are folded to one date per subject before they meet the amendments, so a subject
    with most votes or most amendments never multiplies rows.
    """
    subject_date = votes.join(sessions, "seduta").groupBy("oggetto").agg(F.min("data").alias("data"))
    return (
        attach(amendments.select("emendamento_id", "oggetto"), subject_date, ["oggetto"], "inner")
        .groupBy("emendamento_id")
        .agg(F.min("data").alias("data"))
    )


def iter_days(df: DataFrame, start: str, end: str) -> DataFrame:
    """Days from presentation to the last state."""
    return df.withColumn("giorni_iter", F.datediff(F.col(end), F.col(start)))


def amendment_counts(links: DataFrame, subjects: DataFrame, with_file: str) -> DataFrame:
    """Distinct amendments per bill, all and with a file, through the subject they share.

    A subject may concern many bills; each of them counts its amendments. Amendments with a
    single subject, which is nearly all of them, are counted per subject before they meet
    the bills, so a subject with most amendments costs one row per bill. Only amendments
    with several subjects are paired with bills, to count each once. Runs jobs.
    """
    flag = F.coalesce(F.bool_or(with_file), F.lit(False))
    pairs = links.filter("oggetto is not null").groupBy("emendamento_id", "oggetto").agg(flag.alias("__file"))
    several = pairs.groupBy("emendamento_id").agg(F.count("*").alias("__n")).filter("__n > 1").select("emendamento_id")
    several = staged(several, "several")
    about = subjects.select("oggetto", "id_fase").na.drop().distinct()

    single = pairs.join(several, "emendamento_id", "left_anti").groupBy("oggetto")
    per_subject = single.agg(F.count("*").alias("n"), count_if(F.col("__file")).alias("f"))
    counted = attach(about, per_subject, ["oggetto"], "inner").groupBy("id_fase").agg(F.sum("n").alias("n"), F.sum("f").alias("f"))

    paired = pairs.join(several, "emendamento_id", "left_semi").join(about, "oggetto")
    paired = paired.groupBy("id_fase").agg(
        F.countDistinct("emendamento_id").alias("n"),
        F.countDistinct(F.when(F.col("__file"), F.col("emendamento_id"))).alias("f"),
    )
    return counted.unionByName(paired).groupBy("id_fase").agg(
        F.sum("n").alias("n_emendamenti"), F.sum("f").alias("n_emendamenti_akn")
    )
