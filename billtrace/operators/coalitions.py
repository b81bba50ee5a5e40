"""Majorities: tenure per group, unknown groups, and bills seen through the coalition.

``governments`` has legislatura, nome, inizio, fine, pm_gruppo and maggioranza (array of
group names); ``groups`` has legislatura and sigla.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.dates import days_between
from .coverage import count_if
from .shape import union_all


def italian_governments(spark: SparkSession) -> DataFrame:
    schema = "legislatura int, nome string, inizio string, fine string, pm_gruppo string, maggioranza array<string>"
    dates = {c: F.to_date(c) for c in ("inizio", "fine")}
    return spark.createDataFrame(fixed.GOVERNMENTS, schema).withColumns(dates)


def italian_groups(spark: SparkSession) -> DataFrame:
    rows = [(leg, g) for leg, names in fixed.GROUPS.items() for g in names]
    return spark.createDataFrame(rows, "legislatura int, sigla string")


def majority_members(governments: DataFrame) -> DataFrame:
    """One row for each group in the majority of a government."""
    return governments.select(
        "legislatura", "nome", "inizio", "fine", F.explode("maggioranza").alias("sigla")
    ).distinct()


def prime_minister_groups(governments: DataFrame) -> DataFrame:
    return governments.select("legislatura", "nome", "inizio", "fine", F.col("pm_gruppo").alias("sigla")).filter(
        "sigla is not null"
    )


def coalitions(governments: DataFrame, groups: DataFrame, as_of: str | Column) -> DataFrame:
    """Days and governments in the majority, days as prime minister's group, per group.

    Groups meet governments through the exploded majority lists, an equi-join on
    (legislatura, sigla). The ordered name list holds the governments of one legislature.
    ``maggioranza`` asks for days above 0, so a government of no length does not count.
    """
    days = days_between("inizio", "fine", as_of).cast("bigint")
    roles = union_all(
        majority_members(governments).withColumn("pm", F.lit(False)),
        prime_minister_groups(governments).withColumn("pm", F.lit(True)),
    )
    is_pm = F.col("pm")
    names = F.collect_list(F.when(~is_pm, F.struct("inizio", "nome")))
    tenure = (
        roles.withColumn("giorni", days)
        .groupBy("legislatura", "sigla")
        .agg(
            F.sum(F.when(~is_pm, F.col("giorni"))).alias("giornialgoverno"),
            count_if(~is_pm).alias("governo"),
            F.sum(F.when(is_pm, F.col("giorni"))).alias("giornipm"),
            F.max(is_pm.cast("int")).alias("primoministro"),
            F.array_join(F.transform(F.array_sort(names), lambda x: x["nome"]), ";").alias("governo_nome"),
        )
    )
    zero = F.lit(0)
    return groups.join(tenure, ["legislatura", "sigla"], "left").select(
        "legislatura",
        F.col("sigla").alias("pol_party"),
        "sigla",
        F.coalesce("giornialgoverno", zero).alias("giornialgoverno"),
        F.coalesce("governo", zero).alias("governo"),
        F.coalesce("giornipm", zero).alias("giornipm"),
        F.coalesce("primoministro", zero).alias("primoministro"),
        F.coalesce("governo_nome", F.lit("")).alias("governo_nome"),
        (F.coalesce("giornialgoverno", zero) > 0).cast("int").alias("maggioranza"),
    )


def unknown_groups(governments: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups that a government names and the group list lacks."""
    cols = ["legislatura", "nome", "sigla"]
    named = union_all(majority_members(governments).select(cols), prime_minister_groups(governments).select(cols))
    return named.distinct().join(groups, ["legislatura", "sigla"], "left_anti")


def side_totals(coalition: DataFrame) -> DataFrame:
    """Groups in the majority and in opposition per legislature, plus the grand total."""
    return coalition.rollup("legislatura").agg(
        F.count("*").alias("n_gruppi"),
        count_if(F.col("maggioranza") == 1).alias("n_maggioranza"),
        count_if(F.col("maggioranza") != 1).alias("n_opposizione"),
    )


def group_names(groups: DataFrame, uri: str, long: str, short: str) -> DataFrame:
    """Short to long name, for the groups that have both."""
    both = groups.filter(F.col(short).isNotNull() & F.col(long).isNotNull())
    return both.groupBy(short).agg(F.max_by(F.col(long), F.struct(F.col(uri), F.col(long))).alias(long))


def majority_share(proponents: DataFrame, act: str, amendment: str, side: str) -> DataFrame:
    """Per act: amendments, those with at least one majority proponent, and the share.

    Proponents are folded to one row per amendment first, so a hot act is summed in parts.
    """
    per_amendment = proponents.groupBy(act, amendment).agg(
        F.coalesce(F.bool_or(F.col(side) == "maggioranza"), F.lit(False)).alias("__maj")
    )
    out = per_amendment.groupBy(act).agg(F.count("*").alias("n_emend"), count_if(F.col("__maj")).alias("n_emend_mag"))
    share = F.try_divide(F.col("n_emend_mag").cast("double") * 100.0, F.col("n_emend").cast("double"))
    return out.withColumn("pct_emend_maggioranza", F.bround(share, 1))


def bill_measures(signatures: DataFrame, act: str, person: str, group: str) -> DataFrame:
    """Signers and distinct groups of each act."""
    return signatures.groupBy(act).agg(
        F.countDistinct(person).alias("n_firmatari"), F.countDistinct(group).alias("n_gruppi_firmatari")
    )
