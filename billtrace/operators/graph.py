"""Patterns over a triple table (s, p, o, o_kind, o_datatype).

Profiles count before they join: an object that a third of all triples point to is first
folded to one row per (predicate, object).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import RDF_TYPE
from ..functions.uris import is_blank_node
from .shape import union_all


def instances(triples: DataFrame, cls: str, type_predicate: str = RDF_TYPE) -> DataFrame:
    """Subjects of a class."""
    return triples.filter((F.col("p") == type_predicate) & (F.col("o") == cls)).select("s").distinct()


def class_counts(triples: DataFrame, k: int | None = None, type_predicate: str = RDF_TYPE) -> DataFrame:
    """Distinct instances of each class, the k largest when ``k`` is given."""
    out = (
        triples.filter(F.col("p") == type_predicate)
        .groupBy(F.col("o").alias("classe"))
        .agg(F.countDistinct("s").alias("n"))
    )
    return out if k is None else out.orderBy(F.col("n").desc(), "classe").limit(k)


def predicate_profile(triples: DataFrame) -> DataFrame:
    """Subjects, values, and the smallest value of each predicate."""
    return triples.groupBy("p").agg(
        F.countDistinct("s").alias("n_soggetti"), F.count("*").alias("n_valori"), F.min("o").alias("esempio")
    )


def describe(triples: DataFrame, subject: str) -> DataFrame:
    """All triples of one subject; the filter reaches the scan."""
    return triples.filter(F.col("s") == subject)


def entity_table(
    triples: DataFrame,
    cls: str | None,
    required: dict[str, str],
    optional: dict[str, str],
    multi: dict[str, str] | None = None,
    type_predicate: str = RDF_TYPE,
) -> DataFrame:
    """One row per subject of a class, a column for each predicate (name to predicate).

    Subjects that lack a required predicate are left out. Predicates with one value fold in
    a single aggregation. Those in ``multi`` may have several values; each value makes a row.
    """
    single = {**required, **optional}
    wanted = [*single.values()] + ([type_predicate] if cls else [])
    aggs = [F.min(F.when(F.col("p") == pred, F.col("o"))).alias(name) for name, pred in single.items()]
    if cls:
        is_type = (F.col("p") == type_predicate) & (F.col("o") == cls)
        aggs.append(F.bool_or(is_type).alias("__is"))
    out = triples.filter(F.col("p").isin(*wanted)).groupBy("s").agg(*aggs)
    if cls:
        out = out.filter("__is").drop("__is")
    for name in required:
        out = out.filter(F.col(name).isNotNull())
    for name, pred in (multi or {}).items():
        values = triples.filter(F.col("p") == pred).select("s", F.col("o").alias(name)).distinct()
        out = out.join(values, "s", "left")
    return out


def chain(triples: DataFrame, predicates: Sequence[str], nodes: Sequence[str]) -> DataFrame:
    """Paths along the predicates, one column for each node; blank nodes are nodes like others."""
    out = None
    for i, pred in enumerate(predicates):
        hop = triples.filter(F.col("p") == pred).select(F.col("s").alias(nodes[i]), F.col("o").alias(nodes[i + 1]))
        hop = hop.distinct()
        out = hop if out is None else out.join(hop, nodes[i])
    return out.select(*nodes)


def resolve_blank_nodes(triples: DataFrame) -> DataFrame:
    """(s, p, nodo, inner predicate, value) for every object that is a blank node."""
    outer = triples.filter(F.col("o_kind") == "bnode").select("s", "p", F.col("o").alias("nodo")).distinct()
    inner = triples.filter(is_blank_node("s")).select(F.col("s").alias("nodo"), F.col("p").alias("p_inner"), F.col("o").alias("valore")).distinct()
    return outer.join(inner, "nodo").select("s", "p", "nodo", "p_inner", "valore")


def collapse_blank_nodes(triples: DataFrame, predicate: str, fields: Sequence[str]) -> DataFrame:
    """Blank nodes of a predicate that carry the same content become one row per subject."""
    nodes = triples.filter(F.col("p") == predicate).select("s", F.col("o").alias("__b")).distinct()
    aggs = [F.min(F.when(F.col("p") == f, F.col("o"))).alias(f) for f in fields]
    content = triples.filter(F.col("p").isin(*fields)).groupBy(F.col("s").alias("__b")).agg(*aggs)
    return nodes.join(content, "__b").drop("__b").distinct()


def _types(triples: DataFrame, type_predicate: str, node: str, name: str) -> DataFrame:
    return (
        triples.filter(F.col("p") == type_predicate)
        .select(F.col("s").alias(node), F.col("o").alias(name))
        .distinct()
    )


def reachable_types(triples: DataFrame, cls: str, type_predicate: str = RDF_TYPE) -> DataFrame:
    """Classes one hop away from the instances of a class, by predicate."""
    links = triples.filter(F.col("o_kind") != "literal").filter(F.col("p") != type_predicate)
    # No distinct on the right: a hot subject stays a plain join key, which can be split.
    of_class = triples.filter((F.col("p") == type_predicate) & (F.col("o") == cls)).select("s")
    own = links.join(of_class, "s", "left_semi").select("s", "p", "o").distinct()
    folded = own.groupBy("p", "o").agg(F.count("*").alias("__n"))
    return (
        folded.join(_types(triples, type_predicate, "o", "tipo"), "o")
        .groupBy("p", "tipo")
        .agg(F.sum("__n").alias("n"))
    )


def linking_predicates(triples: DataFrame, source: str, target: str, type_predicate: str = RDF_TYPE) -> DataFrame:
    """Predicates leading from one class to another, with the number of links."""
    reached = reachable_types(triples, source, type_predicate)
    return reached.filter(F.col("tipo") == target).select("p", "n")


def neighbours(triples: DataFrame) -> DataFrame:
    """Every link seen from both ends."""
    links = triples.filter(F.col("o_kind") != "literal")
    out = links.select(F.col("s").alias("nodo"), "p", F.col("o").alias("vicino"), F.lit("uscente").alias("verso"))
    back = links.select(F.col("o").alias("nodo"), "p", F.col("s").alias("vicino"), F.lit("entrante").alias("verso"))
    return union_all(out, back).distinct()


def predicate_presence(triples: DataFrame, candidates: DataFrame) -> DataFrame:
    """For each candidate predicate: does it occur, how often, and an example."""
    found = triples.groupBy("p").agg(F.count("*").alias("n"), F.min("o").alias("esempio"))  # counted before it is joined
    return candidates.join(found, "p", "left").select(
        "p", F.col("n").isNotNull().alias("esiste"), F.coalesce("n", F.lit(0)).alias("n"), "esempio"
    )


def instances_by(triples: DataFrame, cls: str, group_predicate: str, type_predicate: str = RDF_TYPE) -> DataFrame:
    """Instances of a class per value of a predicate, and with a NULL group the total without it.

    An instance counts in each of its groups, and one without a group in the total alone, so the
    total is a check on the sum.
    """
    of_class = triples.filter((F.col("p") == type_predicate) & (F.col("o") == cls)).select("s")
    grouped = triples.filter(F.col("p") == group_predicate).join(of_class, "s", "left_semi").select("s", F.col("o").alias("gruppo")).distinct()
    total = instances(triples, cls, type_predicate).agg(F.lit(None).cast("string").alias("gruppo"), F.count("*").alias("n"))
    return union_all(grouped.groupBy("gruppo").agg(F.count("*").alias("n")), total)


def datatypes(triples: DataFrame) -> DataFrame:
    """Literal datatypes in use, by predicate; plain literals have none."""
    literals = triples.filter(F.col("o_kind") == "literal")
    return literals.groupBy("p", "o_datatype").agg(F.count("*").alias("n"))
