"""Chamber acts, signatories, state history and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..fixed_values import SOURCE_CAMERA
from ..functions.dates import parse_yyyymmdd
from ..functions.texts import full_name
from ..functions.uris import uri_tail
from ..operators.coverage import coverage
from ..operators.joins import attach
from ..operators.picks import earliest, first_per_key, first_role_wins, latest
from ..operators.shape import canonical, present, tolerant_int, with_constants, without_blank_keys
from ..operators.signatories import procedure_dates, role_union, signatory_summary, with_groups


def kind_of_act(kinds: DataFrame) -> DataFrame:
    """Label of the kind of each act, or the tail of its URI: the smallest URI decides."""
    label = F.coalesce(F.nullif(F.col("natura_label"), F.lit("")), F.nullif(uri_tail("natura_uri"), F.lit("")))
    return kinds.groupBy("atto").agg(F.min_by(label, F.struct("natura_uri", "natura_label")).alias("natura"))


def state_history(states: DataFrame) -> DataFrame:
    """Every state of every act once, with its date."""
    once = first_per_key(states, ["atto", "stato"], [])
    return once.select(
        uri_tail("atto").alias("id_atto"),
        "legislatura",
        F.col("stato").alias("stato_uri"),
        "si_label",
        parse_yyyymmdd("si_date").alias("si_date"),
    )


def chamber_signers(first: DataFrame, others: DataFrame, names: DataFrame, memberships: DataFrame) -> DataFrame:
    """One row per act and deputy; the first-signer role wins over the other."""
    who = names.groupBy("dep").agg(F.min(full_name("nome", "cognome")).alias("nome_deputato"))
    # Equal rows needn't be dropped first: one row of each act and deputy stays.
    roles = role_union(first, others, once=False).withColumn("is_primo_firmatario", F.col("ruolo") == "primo").drop("ruolo")
    rows = first_role_wins(roles, ["atto", "dep"], "is_primo_firmatario")
    rows = attach(rows, who, ["dep"])
    rows = rows.select(
        uri_tail("atto").alias("id_atto"),
        "legislatura",
        F.col("dep").alias("uri_deputato"),
        "nome_deputato",
        "is_primo_firmatario",
    )
    groups = without_blank_keys(memberships, "uri_deputato")
    out = with_groups(rows, groups, "uri_deputato", "start", ["gruppo_uri", "gruppo_nome", "gruppo_sigla"])
    return canonical(out, schemas.CHAMBER_SIGNER_COLUMNS)


def chamber_acts(
    acts: DataFrame,
    kinds: DataFrame,
    states: DataFrame,
    versions: DataFrame,
    signers: DataFrame,
    fetched_at: str | None = None,
) -> DataFrame:
    """Acts with kind, last state, first text version, signatories and procedure dates.

    The presentation date is that of the earliest text version, else of the act.
    """
    last = latest(states, ["atto"], "si_date", ["si_label"])
    text = earliest(versions, ["atto"], "vta_date", ["vta_url"])
    out = first_per_key(acts, ["atto"], [])
    for side in (kind_of_act(kinds), last, text):
        out = out.join(side, "atto", "left")
    out = out.select(
        uri_tail("atto").alias("id_atto"),
        tolerant_int("id").alias("id_numerico"),
        "legislatura",
        "titolo",
        parse_yyyymmdd(F.coalesce("vta_date", "dc_date")).alias("data_presentazione"),
        F.col("tipo").alias("tipo_atto"),
        "natura",
        "iniziativa",
        F.col("si_label").alias("stato_iter"),
        parse_yyyymmdd("si_date").alias("data_stato_iter"),
        F.col("vta_url").alias("url_testo_presentato"),
        present("vta_url").alias("has_testo"),
        "url_scheda_camera",
    )
    # Sent once, by act: an act has a row for each of its deputies at most, so no task gets more than these of one key.
    signers = signers.select("id_atto", "uri_deputato", "nome_deputato", "is_primo_firmatario").repartition("id_atto")
    summary = signatory_summary(signers, "id_atto", "uri_deputato", "nome_deputato", "is_primo_firmatario")
    dates = procedure_dates(state_history(states), "id_atto", "si_label", "si_date")
    out = out.join(summary, "id_atto", "left").join(dates, "id_atto", "left")
    out = with_constants(out, fonte=SOURCE_CAMERA, data_fetch=F.lit(fetched_at).cast("string"))
    return canonical(out, schemas.CHAMBER_ACT_COLUMNS)


def chamber_coverage(acts: DataFrame) -> DataFrame:
    """Coverage per legislature; acts without one are left out."""
    return coverage(
        acts,
        ["legislatura"],
        {
            "has_testo": F.col("has_testo"),
            "has_natura": present("natura"),
            "has_stato": present("stato_iter"),
            "has_primo_firmatario": present("primo_firmatario_uri"),
            "has_cofirmatari": F.coalesce("n_cofirmatari", F.lit(0)) > 0,
            "has_data_assegnazione": present("data_prima_assegnazione"),
            "has_data_approvazione": present("data_approvazione"),
        },
        percents=[
            "has_testo",
            "has_natura",
            "has_stato",
            "has_primo_firmatario",
            "has_data_assegnazione",
            "has_data_approvazione",
        ],
        total="n_atti",
        keep_null_groups=False,
    )
