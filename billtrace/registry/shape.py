"""Projections, filters, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import SOURCE_CAMERA
from ..functions import texts
from ..operators import shape
from ..operators.coverage import top_values
from .base import Tables, query


@query("p1_canonical_columns", "SELECT natura, id_atto, legislatura, data_presentazione, ramo_origine, id_ddl, importo FROM acts", "acts")
def p1(t: Tables):
    return shape.canonical(t.role("acts"), ["natura", "id_atto", "manca"])


@query("p2_constants", f"SELECT c_custkey, '{SOURCE_CAMERA}' AS fonte, 19 AS legislatura FROM customer")
def p2(t: Tables):
    return shape.with_constants(t("customer").select("c_custkey"), fonte=SOURCE_CAMERA, legislatura=19)


@query("p3_rename_drop", "SELECT c_custkey AS id, c_name AS nome FROM customer")
def p3(t: Tables):
    df = t("customer").withColumnsRenamed({"c_custkey": "id", "c_name": "nome"})
    return df.drop("c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "p4_presence_flags",
    """SELECT id_fase, ramo_origine IS NOT NULL AS has_ramo, natura IS NOT NULL AS has_natura, n_emendamenti > 0 AS has_emend
       FROM phases""",
    "phases",
)
def p4(t: Tables):
    return t.role("phases").select(
        "id_fase",
        shape.present("ramo_origine").alias("has_ramo"),
        shape.present("natura").alias("has_natura"),
        (F.col("n_emendamenti") > 0).alias("has_emend"),
    )


@query(
    "p5_text_flag",
    """SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_linenumber < 5 THEN CAST(l_linenumber AS STRING) END = '1', false) AS is_primo
       FROM lineitem""",
)
def p5(t: Tables):
    raw = F.when(F.col("l_linenumber") < 5, F.col("l_linenumber").cast("string"))
    return t("lineitem").select("l_orderkey", "l_linenumber", shape.is_flag(raw).alias("is_primo"))


@query(
    "p6_membership_filter",
    """SELECT id_atto, 'dentro' AS lato FROM acts WHERE legislatura IN (1996, 1998) AND natura NOT IN ('5-LOW', '1-URGENT')
       UNION ALL SELECT id_atto, 'fuori' FROM acts WHERE legislatura NOT IN (1996, 1998) AND natura IN ('5-LOW')""",
    "acts",
)
def p6(t: Tables):
    acts = t.role("acts")
    chosen = F.col("legislatura").isin(1996, 1998)
    inside = acts.filter(chosen & ~F.col("natura").isin("5-LOW", "1-URGENT"))
    outside = acts.filter(~chosen & F.col("natura").isin("5-LOW"))
    return shape.tagged_union({"dentro": inside.select("id_atto"), "fuori": outside.select("id_atto")}, "lato")


@query("p7_missing_columns", "SELECT s_suppkey, s_name, CAST(NULL AS STRING) AS sigla, 0 AS n_cofirmatari FROM supplier")
def p7(t: Tables):
    schema = T.StructType().add("s_suppkey", "long").add("sigla", "string").add("n_cofirmatari", T.IntegerType())
    return shape.ensure_columns(t("supplier").select("s_suppkey", "s_name"), schema, {"n_cofirmatari": 0})


@query(
    "p8_zero_fill",
    "SELECT c_custkey, CAST(coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END, 0) AS INTEGER) AS n FROM customer",
)
def p8(t: Tables):
    df = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("n"))
    return shape.zero_filled(df, ["n"])


@query("p9_downloadable", "SELECT id_fase FROM phases WHERE has_testo_presentato AND is_prima_fase AND ramo_origine = 'S'", "phases")
def p9(t: Tables):
    return shape.downloadable(t.role("phases")).select("id_fase")


@query("p10_substring_filter", "SELECT page_id, url FROM pages WHERE contains(lower(url), 'blog')")
def p10(t: Tables):
    return t("pages").filter(texts.contains_any("url", ["blog"])).select("page_id", "url")


@query(
    "p11_uri_list_filter",
    "SELECT l_orderkey, l_suppkey FROM lineitem SEMI JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 8000) x ON l_suppkey = s_suppkey",
)
def p11(t: Tables):
    wanted = t("supplier").filter("s_acctbal > 8000").select(F.col("s_suppkey").alias("l_suppkey"))
    return t("lineitem").select("l_orderkey", "l_suppkey").join(wanted, "l_suppkey", "left_semi")


@query(
    "p12_key_range",
    "SELECT c_name, c_custkey FROM customer WHERE c_name > 'Customer#000000100' AND c_name <= 'Customer#000000900'",
)
def p12(t: Tables):
    df = shape.key_range(t("customer"), "c_name", "Customer#000000100", "Customer#000000900")
    return df.select("c_name", "c_custkey")


@query(
    "p13_tolerant_cast",
    """SELECT id, try_cast(id AS INTEGER) AS id_numerico FROM (
         SELECT CASE WHEN o_orderkey % 10 = 0 THEN concat(o_orderkey, '-B') ELSE CAST(o_orderkey AS STRING) END AS id FROM orders)""",
)
def p13(t: Tables):
    key = F.col("o_orderkey").cast("string")
    df = t("orders").select(F.when(F.col("o_orderkey") % 10 == 0, F.concat(key, F.lit("-B"))).otherwise(key).alias("id"))
    return df.withColumn("id_numerico", shape.tolerant_int("id"))


@query(
    "p14_blank_keys",
    "SELECT l_orderkey, concat('persona/', l_suppkey) AS persona FROM lineitem WHERE l_suppkey % 4 NOT IN (0, 1)",
)
def p14(t: Tables):
    kind = F.col("l_suppkey") % 4
    key = F.when(kind == 0, F.concat(F.lit("nodeID://"), F.col("l_suppkey"))).when(kind == 1, F.lit(None)).otherwise(
        F.concat(F.lit("persona/"), F.col("l_suppkey"))
    )
    return shape.without_blank_keys(t("lineitem").select("l_orderkey", key.alias("persona")), "persona")


@query("p15_bills_only", "SELECT p_partkey, p_type FROM part WHERE p_type <> 'ECONOMY'")
def p15(t: Tables):
    return t("part").select("p_partkey", "p_type").filter(F.col("p_type") != "ECONOMY")


# ---- sorts: the order itself shows as a top-k ------------------------------

CODE = "CASE WHEN p_partkey % 5 = 0 THEN concat(p_size, '-bis') ELSE CAST(p_size AS STRING) END"


def _codes(t):
    size = F.col("p_size").cast("string")
    code = F.when(F.col("p_partkey") % 5 == 0, F.concat(size, F.lit("-bis"))).otherwise(size)
    return t("part").select("p_partkey", code.alias("codice"))


@query(
    "o1_numeric_text_sort",
    f"SELECT p_partkey, codice FROM (SELECT p_partkey, {CODE} AS codice FROM part) ORDER BY try_cast(codice AS BIGINT) NULLS FIRST, p_partkey",
)
def o1(t: Tables):
    return _codes(t).orderBy(F.col("codice").try_cast("bigint").asc_nulls_first(), "p_partkey")


@query("o2_sort_descending", "SELECT id_atto, importo FROM acts ORDER BY importo DESC, id_atto", "acts")
def o2(t: Tables):
    return t.role("acts").select("id_atto", "importo").orderBy(F.col("importo").desc(), "id_atto")


@query("o3_multi_key_sort", "SELECT legislatura, ramo_origine, id_atto FROM acts ORDER BY legislatura, ramo_origine, id_atto", "acts")
def o3(t: Tables):
    return t.role("acts").select("legislatura", "ramo_origine", "id_atto").orderBy("legislatura", "ramo_origine", "id_atto")


@query("o4_top_k", "SELECT id_atto, importo FROM acts ORDER BY importo DESC, id_atto LIMIT 50", "acts")
def o4(t: Tables):
    return t.role("acts").select("id_atto", "importo").orderBy(F.col("importo").desc(), "id_atto").limit(50)


@query(
    "o5_nulls_last",
    "SELECT person_id, member_id, fine FROM memberships ORDER BY fine DESC NULLS LAST, member_id",
    "memberships",
)
def o5(t: Tables):
    df = t.role("memberships").select("person_id", "member_id", "fine")
    return df.orderBy(F.col("fine").desc_nulls_last(), "member_id")


# ---- set operations ---------------------------------------------------------


@query(
    "u1_union_by_name",
    """SELECT id_atto, importo, natura FROM acts WHERE legislatura = 1995
       UNION ALL SELECT id_atto, NULL, natura FROM acts WHERE legislatura <> 1995""",
    "acts",
)
def u1(t: Tables):
    acts = t.role("acts")
    old = acts.filter("legislatura = 1995").select("id_atto", "importo", "natura")
    return shape.union_all(old, acts.filter("legislatura <> 1995").select("natura", "id_atto"))


@query(
    "u2_replace_partitions",
    """SELECT legislatura, id_atto, 'vecchio' AS versione FROM acts WHERE legislatura < 1997
       UNION ALL SELECT legislatura, id_atto, 'nuovo' FROM acts WHERE legislatura >= 1997 AND id_atto % 2 = 0""",
    "acts",
)
def u2(t: Tables):
    acts = t.role("acts").select("legislatura", "id_atto")
    existing = acts.withColumn("versione", F.lit("vecchio"))
    new = acts.filter("legislatura >= 1997 and id_atto % 2 = 0").withColumn("versione", F.lit("nuovo"))
    return shape.replace_partitions(existing, new, ["legislatura"])


@query(
    "u3_role_union",
    """SELECT DISTINCT id_atto, person_id, 'primo' AS ruolo FROM signatures WHERE is_primo
       UNION ALL SELECT DISTINCT id_atto, person_id, 'altro' FROM signatures WHERE NOT is_primo""",
    "signatures",
)
def u3(t: Tables):
    from ..operators.signatories import role_union

    s = t.role("signatures")
    cols = ["id_atto", "person_id"]
    return role_union(s.filter("is_primo").select(cols), s.filter("not is_primo").select(cols))


@query("u4_distinct", "SELECT DISTINCT s, p, o FROM triples", "triples")
def u4(t: Tables):
    return t.role("triples").select("s", "p", "o").distinct()


@query(
    "u5_missing_partitions",
    "SELECT DISTINCT legislatura FROM acts WHERE legislatura NOT IN (SELECT legislatura FROM acts WHERE natura = '5-LOW' AND legislatura % 2 = 0)",
    "acts",
)
def u5(t: Tables):
    acts = t.role("acts")
    have = acts.filter("natura = '5-LOW' and legislatura % 2 = 0")
    return shape.missing_partitions(acts, have, ["legislatura"])


@query(
    "u6_kind_intersection",
    """SELECT DISTINCT o_custkey, CASE o_orderkey % 9 WHEN 0 THEN 'ddlpres' WHEN 3 THEN 'emend' WHEN 4 THEN 'emendc' END AS kind
       FROM orders WHERE o_orderkey % 9 IN (0, 3, 4)""",
)
def u6(t: Tables):
    kinds = F.array(F.lit("ddlpres"), F.lit("emend"), F.lit("emendc"))
    kind = F.element_at(
        F.array(*[F.lit(k) for k in ("ddlpres", "a", "b", "emend", "emendc", "c", "d", "e", "f")]),
        (F.col("o_orderkey") % 9 + 1).cast("int"),
    )
    have = t("orders").select("o_custkey", F.array_intersect(F.array(kind), kinds).alias("k"))
    return have.select("o_custkey", F.explode("k").alias("kind")).distinct()


@query(
    "u7_neighbour_union",
    """SELECT DISTINCT s AS nodo, p, o AS vicino, 'uscente' AS verso FROM triples WHERE o_kind <> 'literal'
       UNION SELECT DISTINCT o, p, s, 'entrante' FROM triples WHERE o_kind <> 'literal'""",
    "triples",
)
def u7(t: Tables):
    from ..operators.graph import neighbours

    return neighbours(t.role("triples"))


@query("a17_top_labels", "SELECT natura, count(*) AS n FROM acts GROUP BY natura ORDER BY n DESC, natura LIMIT 3", "acts")
def a17(t: Tables):
    return top_values(t.role("acts"), ["natura"], 3)
