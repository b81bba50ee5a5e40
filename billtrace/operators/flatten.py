"""Nested documents to tables and back.

``consolidate`` nests the children of an act in parts of bounded size: an act with a third
of all amendments becomes many rows with the same ``atto_id``, so no task holds it whole.
``flatten_act`` takes one part or many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import START_VERSION
from ..functions.texts import fix_encoding, join_texts, or_default, target_article
from ..functions.uris import uri_tail
from .intervals import asof_interval
from .joins import attach
from .picks import first_in_document, first_per_key


def one_per_version(bills: DataFrame) -> DataFrame:
    """One parsed file for each act and version: the first path wins."""
    return first_per_key(bills.filter("error is null"), ["atto_id", "versione"], [F.col("path")])


def with_metadata(amendments: DataFrame) -> DataFrame:
    """Parsed amendments that carry identification."""
    return amendments.filter(F.col("error").isNull() & F.col("id").isNotNull())


def bill_signers(bills: DataFrame, version: str = START_VERSION) -> DataFrame:
    """Signers listed by the presented version, in document order."""
    rows = first_in_document(
        bills.filter(F.col("versione") == version).select("atto_id", "proponents"), "proponents", "__first", "x"
    )
    return rows.select(
        "atto_id",
        F.col("x.name").alias("nome"),
        F.col("x.genere").alias("genere"),
        F.coalesce("x.primo_firmatario", F.lit(False)).alias("primo_firmatario"),
    )


def articles(bills: DataFrame) -> DataFrame:
    """One row for each article of each version, its paragraphs joined by a line break."""
    a = F.col("a")
    rows = bills.select("atto_id", "versione", F.explode("articles").alias("a"))
    return rows.withColumn("__text", join_texts(a["paragraphs"], "text")).select(
        "atto_id",
        a["id"].alias("articolo_id"),
        a["num"].alias("numero_articolo"),
        fix_encoding(a["heading"]).alias("titolo"),
        "versione",
        fix_encoding("__text").alias("testo_integrale"),
    )


def amendment_rows(amendments: DataFrame) -> DataFrame:
    """Amendments by id; of several copies the first path stays."""
    once = first_per_key(amendments, ["id"], [F.col("path")])
    return once.withColumn("__text", join_texts("content")).select(
        "atto_id",
        F.col("id").alias("emendamento_id"),
        F.col("number").alias("numero_emendamento"),
        target_article("number", "target_info").alias("articolo_target"),
        F.col("date").try_cast("date").alias("data"),
        "target_info",
        fix_encoding("__text").alias("testo_emendamento"),
    )


def proponent_id(href: Column, listed_id: Column) -> Column:
    return F.coalesce(F.nullif(F.substring_index(href, "/", -1), F.lit("")), listed_id)


def proponent_rows(amendments: DataFrame, persons: DataFrame) -> DataFrame:
    """Proponents of every copy of an amendment, with the group held on its date.

    ``persons`` has id, full_name, gender and the array ``gruppi``. A person who is not
    listed keeps the name from the file and has no group.
    """
    listed = amendments.select(
        F.col("id").alias("emendamento_id"), F.col("date").try_cast("date").alias("data"), F.explode("proponents").alias("x")
    ).select(
        "emendamento_id", "data", proponent_id(F.col("x.href"), F.col("x.id")).alias("proponente_id"),
        F.col("x.name").alias("__file_name"),
    )
    spans = persons.select(F.col("id").alias("proponente_id"), F.posexplode("gruppi").alias("__pos", "g")).select(
        "proponente_id",
        "__pos",
        F.col("g.nome").alias("proponente_gruppo"),
        F.col("g.inizio").try_cast("date").alias("__start"),
        F.col("g.fine").try_cast("date").alias("__end"),
    )
    people = first_per_key(persons.drop("gruppi"), ["id"], [F.col("full_name")]).select(
        F.col("id").alias("proponente_id"), "full_name", "gender", F.lit(True).alias("__listed")
    )
    grouped = asof_interval(
        listed, spans, "proponente_id", "data", "__start", "__end", [F.col("__pos")], "proponente_gruppo", people=people
    )
    name = F.when(F.col("__listed"), F.col("full_name")).otherwise(F.col("__file_name"))
    return attach(grouped, people, ["proponente_id"]).select(
        "emendamento_id",
        "proponente_id",
        name.alias("proponente_nome"),
        "proponente_gruppo",
        F.col("gender").alias("proponente_genere"),
    )


def nest(children: DataFrame, key: str, child: Column, order: Column, name: str, per_part: int = 10_000) -> DataFrame:
    """Children of a key as sorted arrays of about ``per_part`` elements, one row per part.

    The number of parts comes from the count of children; which part a child goes to
    depends on its hash. Nothing is left out.
    """
    counts = children.groupBy(key).agg(F.ceil(F.count("*") / F.lit(per_part)).alias("__parts"))
    packed = children.select(key, F.struct(order.alias("__order"), child.alias("__child")).alias("__x"))
    spread = attach(packed, counts, [key], "inner").withColumn("parte", F.pmod(F.xxhash64("__x"), F.col("__parts")).cast("int"))
    arrays = spread.groupBy(key, "parte").agg(F.array_sort(F.collect_list("__x")).alias("__all"))
    return arrays.select(key, "parte", F.transform("__all", lambda x: x["__child"]).alias(name))


def enriched_proponents(amendments: DataFrame, persons: DataFrame) -> DataFrame:
    """The proponents of each amendment file (by path) as an array of id, name, group and gender."""
    rows = proponent_rows(amendments.withColumn("id", F.col("path")), persons)
    one = F.struct(
        F.col("proponente_id").alias("id"), F.col("proponente_nome").alias("name"),
        F.col("proponente_gruppo").alias("group"), F.col("proponente_genere").alias("gender"),
    )
    return rows.groupBy(F.col("emendamento_id").alias("path")).agg(F.array_sort(F.collect_list(one)).alias("enriched_proponents"))


def consolidate(acts: DataFrame, bills: DataFrame, signers: DataFrame, amendments: DataFrame, per_part: int = 10_000) -> DataFrame:
    """Nested act documents: legislature, versions and signers in part 0, amendments spread over the parts.

    ``acts`` has atto_id and leg. An act has at most three versions, so its map of versions is small.
    """
    versions = one_per_version(bills).groupBy("atto_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("versione", F.struct("date", "number", "type", "articles"))))).alias(
            "ddl_versions"
        )
    )
    firm = nest(signers, "atto_id", F.struct("nome", "genere", "primo_firmatario"),
                F.struct(~F.col("primo_firmatario"), "nome"), "firmatari_atto", per_part)
    cols = [c for c in amendments.columns if c != "atto_id"]
    emend = nest(amendments, "atto_id", F.struct(*cols), F.col("id"), "amendments", per_part)
    head = acts.join(versions, "atto_id", "left").withColumn("parte", F.lit(0))
    return head.join(firm, ["atto_id", "parte"], "outer").join(emend, ["atto_id", "parte"], "outer")


def flatten_act(docs: DataFrame) -> dict[str, DataFrame]:
    """Act documents, whole or in parts, to acts, signers, articles, amendments and proponents."""
    versions = docs.select("atto_id", F.explode("ddl_versions").alias("versione", "v"))
    bills = versions.select("atto_id", "versione", F.col("v.articles").alias("articles"))
    amendments = docs.select("atto_id", F.explode("amendments").alias("e")).select("atto_id", "e.*")
    signers = docs.select("atto_id", F.explode("firmatari_atto").alias("f")).select("atto_id", "f.*")
    proponents = amendments.select(F.col("id").alias("emendamento_id"), F.explode("enriched_proponents").alias("x"))
    return {
        "t_atti": docs.filter(F.col("leg").isNotNull()).select("atto_id", F.col("leg").alias("legislatura")).distinct(),
        "t_firmatari_atto": signers,
        "t_articoli": articles(bills),
        "t_emendamenti": amendment_rows(amendments),
        "t_proponenti": proponents.select(
            "emendamento_id",
            F.col("x.id").alias("proponente_id"),
            F.col("x.name").alias("proponente_nome"),
            F.col("x.group").alias("proponente_gruppo"),
            F.col("x.gender").alias("proponente_genere"),
        ),
    }


def flatten_persons(persons: DataFrame) -> DataFrame:
    """One row per person and membership; persons without one stay, with NULLs."""
    return persons.select(
        F.col("id").alias("senatore_id"),
        "full_name",
        "first_name",
        "last_name",
        "gender",
        "birth_date",
        F.explode_outer("gruppi").alias("g"),
    ).select(
        "senatore_id",
        "full_name",
        "first_name",
        "last_name",
        "gender",
        "birth_date",
        F.col("g.nome").alias("gruppo_nome"),
        F.col("g.inizio").alias("gruppo_inizio"),
        F.col("g.fine").alias("gruppo_fine"),
        F.col("g.uri").alias("gruppo_uri"),
    )


def explode_votes(votes: DataFrame, key: str, lists: dict[str, str]) -> DataFrame:
    """One row for each person and choice; ``lists`` maps a choice to its array column."""
    pairs = F.array(*[F.struct(F.lit(v).alias("voto"), F.col(c).alias("chi")) for v, c in lists.items()])
    others = [c for c in votes.columns if c not in lists.values()]
    long = votes.select(*others, F.explode(pairs).alias("x"))
    return long.select(*others, F.col("x.voto").alias("voto"), F.explode("x.chi").alias("id_senatore")).withColumn(
        "id_senatore", uri_tail("id_senatore")
    )


def name_or_unknown(c: Column | str, default: str = "Unknown") -> Column:
    return or_default(c, default)
