"""Row and value picks per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import picks
from ..operators.timeline import iter_days
from .base import Tables, query


@query(
    "w1_latest_membership",
    """SELECT person_id, member_id, inizio, gruppo FROM (
         SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY inizio DESC NULLS LAST, member_id) AS rn FROM memberships) WHERE rn = 1""",
    "memberships",
)
def w1(t: Tables):
    m = t.role("memberships").select("person_id", "member_id", "inizio", "gruppo")
    return picks.latest_membership(m, "person_id", "inizio")


@query(
    "w2_first_role_wins",
    "SELECT id_atto, person_id, bool_or(is_primo) AS is_primo FROM signatures GROUP BY id_atto, person_id",
    "signatures",
)
def w2(t: Tables):
    s = t.role("signatures").select("id_atto", "person_id", "is_primo")
    return picks.first_role_wins(s, ["id_atto", "person_id"], "is_primo")


@query(
    "w3_keep_first",
    """SELECT id_atto, person_id, data_firma, sign_id FROM (SELECT *, row_number() OVER (PARTITION BY id_atto, person_id
         ORDER BY data_firma, sign_id, is_primo) AS rn FROM signatures) WHERE rn = 1""",
    "signatures",
)
def w3(t: Tables):
    s = t.role("signatures").select("id_atto", "person_id", "data_firma", "sign_id")
    return picks.first_per_key(s, ["id_atto", "person_id"], [F.col("data_firma"), F.col("sign_id")])


@query(
    "w4_last_state",
    """SELECT id_atto, data, stato FROM (SELECT *, row_number() OVER (PARTITION BY id_atto ORDER BY data DESC, stato DESC) AS rn FROM history) WHERE rn = 1""",
    "history",
)
def w4(t: Tables):
    return picks.latest(t.role("history"), ["id_atto"], "data", ["stato"])


@query(
    "w5_first_version",
    """SELECT a.id_atto, coalesce(v.si_date, a.data_presentazione) AS data_presentazione, v.url FROM acts a LEFT JOIN (
         SELECT id_atto, si_date, url FROM (SELECT l_orderkey AS id_atto, CAST(l_shipdate AS DATE) AS si_date, concat('http://testi/', l_partkey) AS url,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, concat('http://testi/', l_partkey)) AS rn FROM lineitem WHERE l_linestatus = 'O') WHERE rn = 1) v
       ON a.id_atto = v.id_atto""",
    "acts",
)
def w5(t: Tables):
    versions = t("lineitem").filter("l_linestatus = 'O'").select(
        F.col("l_orderkey").alias("id_atto"),
        F.col("l_shipdate").cast("date").alias("data"),
        F.concat(F.lit("http://testi/"), F.col("l_partkey")).alias("url"),
    )
    first = picks.earliest(versions, ["id_atto"], "data", ["url"])
    joined = t.role("acts").select("id_atto", "data_presentazione").join(first, "id_atto", "left")
    return joined.select("id_atto", F.coalesce("data", "data_presentazione").alias("data_presentazione"), "url")


@query(
    "w6_current_or_last_name",
    """SELECT person_id, member_id, gruppo FROM (SELECT *, row_number() OVER (PARTITION BY person_id
         ORDER BY fine IS NULL DESC, CASE WHEN fine IS NULL THEN member_id END, member_id DESC) AS rn FROM memberships) WHERE rn = 1""",
    "memberships",
)
def w6(t: Tables):
    return picks.current_or_last(t.role("memberships"), ["person_id"], "fine", "member_id").select("person_id", "member_id", "gruppo")


@query(
    "w7_first_by_position",
    """SELECT doc_id, CAST(i - 1 AS INTEGER) AS posizione, l[i] AS riga, i = 1 AS primo FROM (
         SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))""",
)
def w7(t: Tables):
    df = t.documents.select("doc_id", F.split("text", "\n").alias("righe"))
    return picks.first_in_document(df, "righe", "primo", "riga")


@query(
    "w8_state_history",
    "SELECT id_atto, stato, min(data) AS data FROM history GROUP BY id_atto, stato ORDER BY id_atto, data, stato",
    "history",
)
def w8(t: Tables):
    return picks.unique_history(t.role("history").select("id_atto", "stato", "data"), "id_atto", "stato", "data")


@query(
    "w9_multi_phase_bills",
    """SELECT id_fase, id_ddl_interno, progressivo_iter FROM phases WHERE id_ddl_interno IN (
         SELECT id_ddl_interno FROM phases GROUP BY 1 HAVING max(progressivo_iter) > 1)""",
    "phases",
)
def w9(t: Tables):
    p = t.role("phases").select("id_fase", "id_ddl_interno", "progressivo_iter")
    return picks.multi_phase(p, "id_ddl_interno", "progressivo_iter")


@query(
    "w10_amendments_once",
    """SELECT e.id, e.testo, p.proponente FROM (
         SELECT id, testo FROM (SELECT l_orderkey AS id, concat('testo ', l_partkey) AS testo,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, concat('testo ', l_partkey), l_suppkey) AS rn FROM lineitem) WHERE rn = 1) e
       JOIN (SELECT l_orderkey AS id, l_suppkey AS proponente FROM lineitem) p ON e.id = p.id""",
)
def w10(t: Tables):
    copies = t("lineitem").select(
        F.col("l_orderkey").alias("id"), "l_linenumber", F.concat(F.lit("testo "), F.col("l_partkey")).alias("testo"),
        F.col("l_suppkey").alias("proponente"),
    )
    once = picks.first_per_key(copies, ["id"], [F.col("l_linenumber"), F.col("testo")]).select("id", "testo")
    return copies.select("id", "proponente").join(once, "id")


@query(
    "w11_days_to_last_state",
    "SELECT id_fase, CAST(date_diff('day', data_presentazione, data_stato_ddl) AS INTEGER) AS giorni_iter FROM phases",
    "phases",
)
def w11(t: Tables):
    return iter_days(t.role("phases"), "data_presentazione", "data_stato_ddl").select("id_fase", "giorni_iter")


@query(
    "w12_kind_label",
    """SELECT id_atto, natura FROM (SELECT l_orderkey AS id_atto, CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS STRING) ELSE concat('Natura ', l_partkey) END AS natura,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY concat('http://natura/', l_partkey)) AS rn FROM lineitem) WHERE rn = 1""",
)
def w12(t: Tables):
    from ..plans.chamber import kind_of_act

    kinds = t("lineitem").select(
        F.col("l_orderkey").alias("atto"),
        F.concat(F.lit("http://natura/"), F.col("l_partkey")).alias("natura_uri"),
        F.when(F.col("l_partkey") % 3 != 0, F.concat(F.lit("Natura "), F.col("l_partkey"))).alias("natura_label"),
    )
    return kind_of_act(kinds).withColumnRenamed("atto", "id_atto")


@query(
    "w13_sample_per_group",
    "SELECT legislatura, id_atto, natura FROM (SELECT *, row_number() OVER (PARTITION BY legislatura ORDER BY id_atto) AS rn FROM acts) WHERE rn <= 5",
    "acts",
)
def w13(t: Tables):
    acts = t.role("acts").select("legislatura", "id_atto", "natura")
    return picks.sample_per_group(acts, ["legislatura"], [F.col("id_atto")], 5)


@query(
    "a9_first_non_null",
    """SELECT id_atto, arg_min(a, data_firma::VARCHAR || lpad(sign_id::VARCHAR, 12, '0')) FILTER (a IS NOT NULL) AS a,
              arg_min(b, data_firma::VARCHAR || lpad(sign_id::VARCHAR, 12, '0')) FILTER (b IS NOT NULL) AS b
       FROM (SELECT id_atto, data_firma, sign_id, nullif(sign_id % 3, 0) AS a, CASE WHEN sign_id % 4 = 1 THEN concat('B', sign_id) END AS b FROM signatures)
       GROUP BY id_atto""",
    "signatures",
)
def a9(t: Tables):
    s = t.role("signatures").select(
        "id_atto", "data_firma", "sign_id", F.nullif(F.col("sign_id") % 3, F.lit(0)).alias("a"),
        F.when(F.col("sign_id") % 4 == 1, F.concat(F.lit("B"), F.col("sign_id"))).alias("b"),
    )
    return picks.first_non_null(s, ["id_atto"], ["a", "b"], ["data_firma", "sign_id"])
