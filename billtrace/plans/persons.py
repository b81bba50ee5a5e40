"""Registry of persons with their group memberships, from joined query rows or triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import full_name
from ..functions.uris import uri_tail
from ..operators.flatten import nest
from ..operators.joins import attach
from ..operators.picks import current_or_last, first_per_key


def group_labels(denominations: DataFrame) -> DataFrame:
    """Current name of each group, else the last listed one."""
    named = denominations.filter("titolo is not null")
    best = current_or_last(named, ["gruppo"], "fine", "pos")
    return best.select("gruppo", F.col("titolo").alias("nome"), F.col("titoloBreve").alias("sigla"))


def membership_rows(memberships: DataFrame, denominations: DataFrame) -> DataFrame:
    """Distinct memberships with group name: denomination, else label, else end of the URI."""
    spans = first_per_key(memberships, ["senatore", "gruppo", "inizio", "fine"], [])
    labelled = attach(spans, group_labels(denominations), ["gruppo"])
    name = F.coalesce("nome", F.nullif(F.col("gruppoLabel"), F.lit("")), uri_tail("gruppo"))
    return labelled.select("senatore", F.col("gruppo").alias("uri"), name.alias("nome"), "inizio", "fine", "sigla")


def person_rows(persons: DataFrame) -> DataFrame:
    """Each person once; a missing label is built from the two names when both exist."""
    once = first_per_key(persons, ["senatore"], [])
    both = F.when(F.col("nome").isNotNull() & F.col("cognome").isNotNull(), full_name("nome", "cognome"))
    return once.select(
        uri_tail("senatore").alias("id"),
        F.col("senatore").alias("uri"),
        F.coalesce(F.nullif(F.col("label"), F.lit("")), both).alias("full_name"),
        F.col("nome").alias("first_name"),
        F.col("cognome").alias("last_name"),
        F.col("genere").alias("gender"),
        F.col("dataNascita").alias("birth_date"),
    )


def registry_persons(persons: DataFrame, memberships: DataFrame, denominations: DataFrame) -> DataFrame:
    """Persons with the array ``gruppi`` in order of start.

    A person with very many memberships comes in several rows (``parte``), each with a part
    of them; ``flatten_persons`` gives the same table either way.
    """
    rows = membership_rows(memberships, denominations)
    entry = F.struct("uri", "nome", "inizio", "fine", "sigla")
    groups = nest(rows, "senatore", entry, F.struct("inizio", "uri"), "gruppi").withColumnRenamed("senatore", "uri")
    return person_rows(persons).join(groups, "uri", "left").select(
        "id", "uri", "full_name", "first_name", "last_name", "gender", "birth_date",
        F.coalesce("gruppi", F.array().cast("array<struct<uri:string,nome:string,inizio:string,fine:string,sigla:string>>")).alias("gruppi"),
        F.coalesce("parte", F.lit(0)).alias("parte"),
    )
