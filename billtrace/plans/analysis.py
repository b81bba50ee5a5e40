"""Growth report, analytic star, complexity table and bill profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import is_government_bill
from ..operators.coalitions import bill_measures
from ..operators.coverage import key_agreement, phase_summary, pivot_counts
from ..operators.joins import attach
from ..operators.measures import act_complexity, growth_vs_fragmentation
from ..operators.picks import multi_phase
from ..operators.timeline import iter_days


def growth_report(articles: DataFrame, amendments: DataFrame, proponents: DataFrame, by_act: bool = False) -> DataFrame:
    """Growth of each article against the fragmentation of its amendments, largest growth first."""
    table = growth_vs_fragmentation(articles, amendments, proponents, by_act)
    return table.orderBy(F.col("delta_words").desc(), "atto_id", "num_clean")


def analytic_star(bills: DataFrame, signers: DataFrame, coalitions: DataFrame) -> dict[str, DataFrame]:
    """Bill facts with derived measures, and signatures with the side of their group.

    The coalition table carries short names, so it joins on (legislatura, sigla).
    """
    sides = coalitions.select("legislatura", F.col("sigla").alias("gruppo_sigla"), F.col("maggioranza").alias("in_maggioranza"))
    signed = attach(signers, sides, ["legislatura", "gruppo_sigla"])
    measures = bill_measures(signers, "id_fase", "uri_iniziativa", "gruppo_uri")
    per_leg = bills.groupBy("legislatura").agg(F.sum("n_emendamenti").alias("n_emendamenti_per_leg"))
    facts = iter_days(bills, "data_presentazione", "data_stato_ddl").join(measures, "id_fase", "left")
    facts = attach(facts, per_leg, ["legislatura"]).withColumn(
        "is_governativo", is_government_bill("natura", "descr_iniziativa")
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_firmatari", "n_gruppi_firmatari")}
    return {"t_atti_senato": facts.withColumns(zero), "t_firmatari_senato": signed}


def complexity_table(articles: DataFrame, act: str, text: str, paragraphs: str, source: str) -> DataFrame:
    return act_complexity(articles, act, text, paragraphs).withColumn("fonte", F.lit(source))


def bill_profile(bills: DataFrame, phases: Sequence[int]) -> dict[str, DataFrame]:
    """Phase summary, phase pivot, agreement of the two ids, and the multi-phase bills."""
    return {
        "summary": phase_summary(bills),
        "pivot": pivot_counts(bills, ["legislatura"], "progressivo_iter", phases, "iter_"),
        "ids": key_agreement(bills, "id_fase", "id_fase_sparql"),
        "multi_phase": multi_phase(bills, "id_ddl_interno", "progressivo_iter"),
    }
