"""Outcomes of votes told in the minutes of a sitting.

A clause names what was voted on, in one list, and what became of it:

    clause  = kind list verdict                 gli emendamenti 3.1, 3.2 e da 4.1 a 4.5 sono respinti
    list    = item ((',' | 'e' | 'ed' | 'nonché') item)*
    item    = number | 'da' number 'a' number
    verdict = ['non'] copula ['non'] ['stato'] outcome

Each part is a pattern of its own, and the clause is put together from them. Everything runs in
array functions of Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"\d+(?:\.\d+)*(?:-(?:bis|ter|quater|quinquies|sexies))?(?![\w]|\.\d)"
RANGE = rf"dal?(?:l['’])?\s*(?:numero\s+)?{NUMBER}\s+al?(?:l['’])?\s*(?:numero\s+)?{NUMBER}"
ITEM = rf"(?:{RANGE}|(?:l['’]|il\s+|i\s+|gli\s+|la\s+|le\s+)?{NUMBER})"
LINK = r"\s*(?:,\s*(?:ed?\s+|nonché\s+)?|\s+ed?\s+|\s+nonché\s+)\s*"
# What can be voted on, and what can become of it, by the stem that tells.
KINDS = {"subemendament": "subemendamento", "emendament": "emendamento", "articol": "articolo", "ordin[ei] del giorno": "ordine del giorno"}
OUTCOMES = {
    "approvat": "approvato",
    "accolt": "approvato",
    "respint": "respinto",
    "ritirat": "ritirato",
    "inammissibil": "inammissibile",
    "improponibil": "inammissibile",
    "accantonat": "accantonato",
    "preclus": "precluso",
    "decadut": "decaduto",
    "assorbit": "assorbito",
}
KIND = rf"\b((?:{'|'.join(KINDS)})[a-z]*)"
COPULA = r"(?:è|sono|risultano|risulta|vengono|viene|vengano|venga|si intendono|si intende)"
VERDICT = rf"((?:non\s+)?{COPULA}\s+(?:non\s+)?(?:stat[oaie]\s+)?(?:dichiarat[oaie]\s+|post[oaie]\s+in votazione e\s+)?(?:{'|'.join(OUTCOMES)})[a-z]*)"
CLAUSE = rf"{KIND}\s+({ITEM}(?:{LINK}{ITEM})*)\s*,?\s+{VERDICT}"
LONGEST_RANGE = 1000


def _numbers(item: Column) -> Column:
    """The numbers an item stands for. A range counts its last part up; one that can't be counted is its two ends."""
    ends = F.regexp_extract_all(item, F.lit(f"({NUMBER})"), F.lit(1))
    split = lambda n: F.struct(F.regexp_extract(n, r"^(.*?)(\d+)$", 1).alias("front"), F.regexp_extract(n, r"^(.*?)(\d+)$", 2).try_cast("int").alias("last"))

    def counted(pair: Column) -> Column:
        low, high = pair["low"], pair["high"]
        fine = (low["front"] == high["front"]) & (low["last"] <= high["last"]) & (high["last"] - low["last"] < LONGEST_RANGE)
        steps = F.transform(F.sequence(low["last"], high["last"]), lambda i: F.concat(low["front"], i.cast("string")))
        return F.when(fine, steps).otherwise(pair["ends"])

    pair = F.struct(split(F.get(ends, F.lit(0))).alias("low"), split(F.get(ends, F.lit(1))).alias("high"), ends.alias("ends"))
    return F.when(F.size(ends) == 2, F.transform(F.array(pair), counted)[0]).otherwise(ends)


def _by_stem(text: Column, stems: dict[str, str]) -> Column:
    out = None
    for stem, label in stems.items():
        hit = F.rlike(text, F.lit(rf"(?:^|[^a-z]){stem}"))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def _outcome(verdict: Column) -> Column:
    """What a verdict says; what is not approved is rejected, other denials are marked as such."""
    plain = _by_stem(verdict, OUTCOMES)
    denied = F.rlike(verdict, F.lit(r"\bnon\b"))
    return F.when(~denied, plain).when(plain == "approvato", "respinto").otherwise(F.concat(F.lit("non "), plain))


def voted_outcomes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, passo, tipo, numero, esito): one row for everything that a clause names.

    ``passo`` numbers the clauses of a text from 1. A number that is named again has a row for each
    time. Case and runs of white space don't matter. NULL and texts without a clause give no rows.
    """
    low = F.lower(F.regexp_replace(F.col(text), r"\s+", " "))
    clauses = F.regexp_extract_all(low, F.lit(CLAUSE), F.lit(0))
    found = df.select(F.col(key), F.posexplode(clauses).alias("at", "clause"))
    part = lambda i: F.regexp_extract("clause", CLAUSE, i)
    parts = found.select(key, (F.col("at") + 1).alias("passo"), F.struct(part(1).alias("kind"), part(2).alias("list"), part(3).alias("verdict")).alias("p"))
    numbers = F.flatten(F.transform(F.regexp_extract_all(F.col("p.list"), F.lit(f"({RANGE}|{NUMBER})"), F.lit(1)), _numbers))
    return parts.select(key, "passo", _by_stem(F.col("p.kind"), KINDS).alias("tipo"), F.explode(numbers).alias("numero"), _outcome(F.col("p.verdict")).alias("esito"))
