"""Senate bills, their signatories and the coverage of both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..fixed_values import SOURCE_SENATO
from ..functions.uris import uri_tail
from ..operators.coverage import coverage
from ..operators.intervals import valid_at
from ..operators.picks import first_per_key, first_values
from ..operators.shape import canonical, is_flag, present, tolerant_int, with_constants, zero_filled
from ..operators.signatories import cosigner_aggregates, with_groups, with_names
from ..operators.timeline import amendment_counts


def bill_phases(raw: DataFrame) -> DataFrame:
    """Bill phases from their raw text columns."""
    return raw.withColumns(
        {
            "id_fase": uri_tail("uri_ddl"),
            "progressivo_iter": tolerant_int("prog_iter"),
            "is_prima_fase": is_flag("prog_iter"),
            "has_testo_presentato": present("urn_testo_presentato"),
            "has_testo_approvato": present("urn_testo_approvato"),
        }
    ).drop("prog_iter")


def memberships_with_names(memberships: DataFrame, denominations: DataFrame) -> DataFrame:
    """Memberships with the group name valid at their start; repeated nodes collapse."""
    named = valid_at(memberships, denominations, "gruppo_uri", "adGInizio", "dnInizio", "dnFine")
    named = named.drop("dnInizio", "dnFine")
    return first_per_key(named, ["uri_senatore", "gruppo_uri", "adGInizio"], [F.col("gruppo_nome")])


def senate_signers(initiatives: DataFrame, names: DataFrame, memberships: DataFrame, denominations: DataFrame) -> DataFrame:
    """One row per bill phase and initiative, with the person's name and latest group."""
    rows = initiatives.withColumn("is_primo_firmatario", is_flag("primo_firmatario")).drop("primo_firmatario")
    rows = first_per_key(rows, ["id_fase", "uri_iniziativa"], [])
    named = with_names(rows, names, "uri_senatore", "nome_senatore", "nome", "cognome")
    groups = memberships_with_names(memberships, denominations)
    cols = ["gruppo_uri", "gruppo_nome", "gruppo_sigla", "carica_gruppo"]
    out = with_groups(named, groups, "uri_senatore", "adGInizio", cols)
    return canonical(out, schemas.SENATE_SIGNER_COLUMNS)


def signer_summary(signers: DataFrame) -> DataFrame:
    """First signer, column by column where several are listed, and co-signer counts of each bill phase."""
    cols = {
        "tipo_iniziativa": "tipo_iniziativa",
        "uri_senatore": "uri_primo_firmatario",
        "nome_senatore": "nome_primo_firmatario",
        "gruppo_uri": "gruppo_primo_firmatario_uri",
        "gruppo_nome": "gruppo_primo_firmatario_nome",
        "gruppo_sigla": "gruppo_primo_firmatario_sigla",
    }
    first = first_values(list(cols), ["uri_iniziativa"], F.col("is_primo_firmatario"))
    counts = cosigner_aggregates("uri_senatore", "is_primo_firmatario")
    return signers.groupBy("id_fase").agg(*first, *counts).withColumnsRenamed(cols)


def senate_bills(
    phases: DataFrame, links: DataFrame, subjects: DataFrame, signers: DataFrame, fetched_at: str | None = None
) -> DataFrame:
    """Bill phases with amendment counts, first signer and co-signer counts."""
    counts = amendment_counts(links, subjects, "has_akn")
    out = phases.join(counts, "id_fase", "left")
    out = zero_filled(out, ["n_emendamenti", "n_emendamenti_akn"])
    out = out.withColumns(
        {"has_emendamenti": F.col("n_emendamenti") > 0, "has_emendamenti_akn": F.col("n_emendamenti_akn") > 0}
    )
    out = out.join(signer_summary(signers), "id_fase", "left")
    out = zero_filled(out, ["n_cofirmatari", "n_cofirmatari_totale"])
    out = with_constants(out, fonte=SOURCE_SENATO, data_fetch=F.lit(fetched_at).cast("string"))
    return canonical(out, schemas.BILL_PHASE_COLUMNS)


def senate_coverage(bills: DataFrame) -> DataFrame:
    """Coverage per legislature and branch; a missing branch is a group of its own."""
    return coverage(
        bills,
        ["legislatura", "ramo_origine"],
        {
            "con_testo_presentato": F.col("has_testo_presentato"),
            "con_emendamenti": F.col("has_emendamenti"),
            "con_emendamenti_akn": F.col("has_emendamenti_akn"),
            "con_primo_firmatario": present("uri_primo_firmatario"),
        },
        sums={"n_emendamenti_totali": F.col("n_emendamenti")},
        percents=["con_testo_presentato", "con_emendamenti_akn", "con_primo_firmatario"],
        total="n_ddl",
    ).withColumnsRenamed(
        {
            "pct_con_testo_presentato": "pct_testo_presentato",
            "pct_con_emendamenti_akn": "pct_emendamenti_akn",
            "pct_con_primo_firmatario": "pct_primo_firmatario",
        }
    )
