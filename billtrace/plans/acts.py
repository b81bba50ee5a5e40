"""Act files to the five act tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import flatten
from ..operators.documents import parse_amendments, parse_bills
from ..session import staged
from ..sources.readers import add_path_parts


def _located(parsed: DataFrame) -> DataFrame:
    return add_path_parts(parsed).withColumn("legislatura", F.col("legislatura").cast("string"))


def _versions(bill_files: DataFrame) -> DataFrame:
    """One parsed file of each act and version. To be written where it has several users: the pick moves whole articles."""
    return flatten.one_per_version(_located(parse_bills(bill_files)).withColumn("versione", F.col("kind")))


TABLES = ("t_atti", "t_firmatari_atto", "t_articoli", "t_emendamenti", "t_proponenti")


def _acts(bills: DataFrame, amendments: DataFrame) -> DataFrame:
    return bills.select("atto_id", "legislatura").union(amendments.select("atto_id", "legislatura")).distinct()


def act_tables(bill_files: DataFrame, amendment_files: DataFrame, persons: DataFrame, wanted: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    """Parse, enrich and flatten straight to the wanted tables; no whole act is ever put in one row.

    Parsed files that feed several of them are written once, which runs a job for each kind.
    """

    def parsed(rows: DataFrame, label: str, *users: str) -> DataFrame:
        return staged(rows, label) if len({*users} & {*wanted}) > 1 else rows

    bills = parsed(_versions(bill_files), "bills", "t_atti", "t_firmatari_atto", "t_articoli")
    amendments = parsed(_located(parse_amendments(amendment_files)), "amendments", "t_atti", "t_emendamenti", "t_proponenti")
    amendments = flatten.with_metadata(amendments)
    tables = {
        "t_atti": lambda: _acts(bills, amendments),
        "t_firmatari_atto": lambda: flatten.bill_signers(bills),
        "t_articoli": lambda: flatten.articles(bills),
        "t_emendamenti": lambda: flatten.amendment_rows(amendments),
        "t_proponenti": lambda: flatten.proponent_rows(amendments, staged(persons, "persons")),
    }
    return {name: tables[name]() for name in wanted}


def build_documents(bill_files: DataFrame, amendment_files: DataFrame, persons: DataFrame, per_part: int = 10_000) -> DataFrame:
    """The nested act documents, in parts of bounded size, with enriched proponents."""
    bills = staged(_versions(bill_files), "bills")
    amendments = flatten.with_metadata(staged(_located(parse_amendments(amendment_files)), "amendments"))
    acts = _acts(bills, amendments).withColumnRenamed("legislatura", "leg")
    enriched = flatten.enriched_proponents(amendments, staged(persons, "persons"))
    kept = amendments.select("atto_id", "path", "id", "date", "number", "name", "target_ddl", "target_info", "proponents", "content")
    kept = kept.join(enriched, "path", "left")
    return flatten.consolidate(acts, bills, flatten.bill_signers(bills), kept, per_part)
