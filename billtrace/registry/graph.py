"""Triple patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph
from ..operators.coverage import field_coverage
from ..operators.picks import first_per_key
from ..operators.signatories import link_presence, membership_stats
from .base import Tables, query

TYPE = "type"


@query("g1_class_counts", "SELECT o AS classe, count(DISTINCT s) AS n FROM triples WHERE p = 'type' GROUP BY o ORDER BY n DESC, classe LIMIT 3", "triples")
def g1(t: Tables):
    return graph.class_counts(t.role("triples"), 3, TYPE)


@query("g2_predicate_profile", "SELECT p, count(DISTINCT s) AS n_soggetti, count(*) AS n_valori, min(o) AS esempio FROM triples GROUP BY p", "triples")
def g2(t: Tables):
    return graph.predicate_profile(t.role("triples"))


@query("g3_describe", "SELECT * FROM triples WHERE s = 'cliente/10'", "triples")
def g3(t: Tables):
    return graph.describe(t.role("triples"), "cliente/10")


@query(
    "g4_entity_table",
    """SELECT x.s, n.o AS nazione, m.o AS nome, g.o AS segmento FROM (SELECT DISTINCT s FROM triples WHERE p = 'type' AND o = 'Cliente') x
       JOIN (SELECT DISTINCT s, o FROM triples WHERE p = 'nazione') n USING (s)
       LEFT JOIN (SELECT DISTINCT s, o FROM triples WHERE p = 'nome') m USING (s)
       LEFT JOIN (SELECT DISTINCT s, o FROM triples WHERE p = 'segmento') g USING (s)""",
    "triples",
)
def g4(t: Tables):
    return graph.entity_table(t.role("triples"), "Cliente", {"nazione": "nazione"}, {"nome": "nome"}, {"segmento": "segmento"}, TYPE)


@query(
    "g5_blank_nodes",
    """SELECT DISTINCT a.s, a.p, a.o AS nodo, b.p AS p_inner, b.o AS valore FROM triples a JOIN triples b ON a.o = b.s WHERE a.o_kind = 'bnode'""",
    "triples",
)
def g5(t: Tables):
    return graph.resolve_blank_nodes(t.role("triples"))


@query(
    "g6_collapse_blank_nodes",
    "SELECT DISTINCT a.s, b.o AS intero FROM triples a JOIN triples b ON a.o = b.s AND b.p = 'intero' WHERE a.p = 'saldo'",
    "triples",
)
def g6(t: Tables):
    return graph.collapse_blank_nodes(t.role("triples"), "saldo", ["intero"])


REACHABLE = """SELECT l.p, ty.o AS tipo, count(*) AS n FROM (SELECT DISTINCT s, p, o FROM triples WHERE o_kind <> 'literal' AND p <> 'type') l
       SEMI JOIN (SELECT s FROM triples WHERE p = 'type' AND o = 'Cliente') c ON l.s = c.s
       JOIN (SELECT DISTINCT s, o FROM triples WHERE p = 'type') ty ON ty.s = l.o GROUP BY l.p, ty.o"""


@query("g7_reachable_types", REACHABLE, "triples")
def g7(t: Tables):
    return graph.reachable_types(t.role("triples"), "Cliente", TYPE)


@query("g8_linking_predicates", f"SELECT p, n FROM ({REACHABLE}) WHERE tipo = 'Nazione'", "triples")
def g8(t: Tables):
    return graph.linking_predicates(t.role("triples"), "Cliente", "Nazione", TYPE)


@query(
    "g9_predicate_candidates",
    """SELECT c.p, t.n IS NOT NULL AS esiste, coalesce(t.n, 0) AS n, t.esempio FROM (
         SELECT DISTINCT p FROM triples UNION SELECT DISTINCT concat('rif_', p) FROM triples) c
       LEFT JOIN (SELECT p, count(*) AS n, min(o) AS esempio FROM triples GROUP BY p) t ON c.p = t.p""",
    "triples",
)
def g9(t: Tables):
    triples = t.role("triples")
    names = triples.select("p").distinct()
    return graph.predicate_presence(triples, names.union(names.select(F.concat(F.lit("rif_"), F.col("p")))))


@query(
    "g10_instances_by_group",
    """WITH x AS (SELECT DISTINCT s FROM triples WHERE p = 'type' AND o = 'Cliente')
       SELECT g.o AS gruppo, count(*) AS n FROM x JOIN (SELECT DISTINCT s, o FROM triples WHERE p = 'segmento') g USING (s) GROUP BY g.o
       UNION ALL SELECT NULL, count(*) FROM x""",
    "triples",
)
def g10(t: Tables):
    return graph.instances_by(t.role("triples"), "Cliente", "segmento", TYPE)


@query(
    "a25_range_of_unlinked",
    """SELECT min(data_presentazione) AS prima, max(data_presentazione) AS ultima, count(DISTINCT id_atto) AS n
       FROM acts ANTI JOIN (SELECT id_atto FROM signatures WHERE is_primo) x USING (id_atto) WHERE importo > 100000""",
    "acts signatures",
)
def a25(t: Tables):
    first = t.role("signatures").filter("is_primo").select("id_atto")
    rest = t.role("acts").filter("importo > 100000").join(first, "id_atto", "left_anti")
    return rest.agg(
        F.min("data_presentazione").alias("prima"), F.max("data_presentazione").alias("ultima"), F.countDistinct("id_atto").alias("n")
    )


@query(
    "a26_link_presence",
    """SELECT l_returnflag AS tipo, count(*) AS n, count(x) AS n_con_link, count(*) - count(x) AS n_senza_link
       FROM (SELECT l_returnflag, CASE WHEN l_suppkey % 3 = 0 THEN l_suppkey END AS x FROM lineitem) GROUP BY l_returnflag""",
)
def a26(t: Tables):
    link = F.when(F.col("l_suppkey") % 3 == 0, F.col("l_suppkey"))
    return link_presence(t("lineitem").select(F.col("l_returnflag").alias("tipo"), link.alias("link")), ["tipo"], "link")


@query(
    "a31_membership_stats",
    """SELECT count(*) AS n_persone, count(m.person_id) AS n_con_adesione FROM (SELECT DISTINCT s_suppkey AS person_id FROM supplier) p
       LEFT JOIN (SELECT DISTINCT person_id FROM memberships) m ON p.person_id = m.person_id""",
    "memberships",
)
def a31(t: Tables):
    persons = t("supplier").select(F.col("s_suppkey").alias("person_id"))
    return membership_stats(persons, t.role("memberships"), "person_id")


@query(
    "a33_field_coverage",
    """SELECT p, count(*) FILTER (k = '0') AS n_0, count(*) FILTER (k = '1') AS n_1, count(*) FILTER (k = '2') AS n_2
       FROM (SELECT DISTINCT p, s FROM triples) JOIN (
         SELECT s, right(min(o), 1) AS k FROM triples WHERE p = 'nazione' GROUP BY s) USING (s) GROUP BY p""",
    "triples",
)
def a33(t: Tables):
    triples = t.role("triples")
    groups = first_per_key(triples.filter("p = 'nazione'").select("s", "o"), ["s"], [F.col("o")])
    groups = groups.select("s", F.right("o", F.lit(1)).alias("k"))
    return field_coverage(triples, groups, "s", "k", ["0", "1", "2"])
