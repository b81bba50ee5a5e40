"""Signatories of acts: roles, summaries, groups and procedure dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import LABEL_APPROVED, LABEL_ASSIGNED
from ..functions.texts import full_name
from .joins import attach
from .picks import latest_membership
from .shape import tagged_union


def role_union(first: DataFrame, others: DataFrame, role: str = "ruolo", once: bool = True) -> DataFrame:
    """First and other signers as one table with a role; equal rows ``once``, or as often as they come."""
    rows = tagged_union({"primo": first, "altro": others}, role)
    return rows.distinct() if once else rows


def with_names(signatures: DataFrame, names: DataFrame, key: str, stored: str, first: str, last: str) -> DataFrame:
    """Replace the stored name by first and last name where the person is listed with one."""
    looked_up = names.select(F.col(key), full_name(first, last).alias("__name")).filter("__name is not null")
    looked_up = looked_up.groupBy(key).agg(F.min("__name").alias("__name"))
    return attach(signatures, looked_up, [key]).select(
        *[c for c in signatures.columns if c != stored],
        F.coalesce(F.col("__name"), F.col(stored)).alias(stored),
    )


def with_groups(
    signatures: DataFrame, memberships: DataFrame, person: str, start: str, cols: Sequence[str]
) -> DataFrame:
    """Signatures with the columns of the person's latest membership."""
    wanted = memberships.select(person, start, *cols).filter(F.col(person).isNotNull())
    return attach(signatures, latest_membership(wanted, person, start).drop(start), [person])


def signatory_summary(signatures: DataFrame, act: str, person: str, name: str, is_first: str) -> DataFrame:
    """First signer and number of distinct co-signers of each act, in one pass."""
    lead = F.when(F.col(is_first), F.struct(F.col(person), F.col(name)))
    return signatures.groupBy(act).agg(
        F.min(lead)[person].alias("primo_firmatario_uri"),
        F.min(lead)[name].alias("primo_firmatario_nome"),
        F.countDistinct(F.when(~F.col(is_first), F.col(person))).alias("n_cofirmatari"),
    )


def cosigner_aggregates(person: str, is_first: str) -> list[Column]:
    """Co-signers with a person link, and all co-signers."""
    other = ~F.col(is_first)
    return [
        F.count(F.when(other & F.col(person).isNotNull(), 1)).alias("n_cofirmatari"),
        F.count(F.when(other, 1)).alias("n_cofirmatari_totale"),
    ]


def cosigner_counts(signatures: DataFrame, act: str, person: str, is_first: str) -> DataFrame:
    return signatures.groupBy(act).agg(*cosigner_aggregates(person, is_first))


def procedure_dates(
    states: DataFrame, act: str, label: str, date: str, labels: dict[str, str] | None = None
) -> DataFrame:
    """First date of each wanted state per act, for the acts that have one of the states."""
    labels = labels or {"data_prima_assegnazione": LABEL_ASSIGNED, "data_approvazione": LABEL_APPROVED}
    wanted = states.filter(F.col(label).isin(*labels.values()))
    firsts = [F.min(F.when(F.col(label) == v, F.col(date))).alias(k) for k, v in labels.items()]
    return wanted.groupBy(act).agg(*firsts)


def link_presence(df: DataFrame, by: Sequence[str], link: str) -> DataFrame:
    """Rows with and without a link, by category."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count(link).alias("n_con_link"),
        (F.count("*") - F.count(link)).alias("n_senza_link"),
    )


def membership_stats(persons: DataFrame, memberships: DataFrame, key: str) -> DataFrame:
    """All persons and those with a membership."""
    members = memberships.select(key).distinct().withColumn("__in", F.lit(1))
    return (
        persons.select(key)
        .distinct()
        .join(members, key, "left")
        .agg(F.count("*").alias("n_persone"), F.count("__in").alias("n_con_adesione"))
    )
