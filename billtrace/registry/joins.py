"""Joins over the role tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coalitions as co
from ..operators import graph
from ..operators.coverage import count_if
from ..operators.intervals import asof_interval, coalition_side, valid_at
from ..operators.measures import fragmentation, growth_vs_fragmentation
from ..operators.signatories import role_union, with_groups, with_names
from ..operators.timeline import amendment_counts, amendment_dates, phases_of_bills
from .base import Tables, query

AS_OF = "2001-01-01"


@query(
    "j1_left_summary",
    """SELECT id_atto, legislatura, coalesce(n, 0) AS n_firme FROM acts
       LEFT JOIN (SELECT id_atto, count(*) AS n FROM signatures GROUP BY id_atto) USING (id_atto)""",
    "acts signatures",
)
def j1(t: Tables):
    per_act = t.role("signatures").groupBy("id_atto").agg(F.count("*").alias("n"))
    joined = t.role("acts").select("id_atto", "legislatura").join(per_act, "id_atto", "left")
    return joined.select("id_atto", "legislatura", F.coalesce("n", F.lit(0)).alias("n_firme"))


@query(
    "j2_full_outer_fill",
    """SELECT id_atto, coalesce(a.n, 0) AS n_primi, coalesce(b.n, 0) AS n_tardi
       FROM (SELECT id_atto, count(*) AS n FROM signatures WHERE is_primo GROUP BY id_atto) a
       FULL JOIN (SELECT id_atto, count(*) AS n FROM signatures WHERE data_firma >= DATE '1999-01-01' GROUP BY id_atto) b USING (id_atto)""",
    "signatures",
)
def j2(t: Tables):
    s = t.role("signatures")
    first = s.filter("is_primo").groupBy("id_atto").agg(F.count("*").alias("n_primi"))
    late = s.filter("data_firma >= date'1999-01-01'").groupBy("id_atto").agg(F.count("*").alias("n_tardi"))
    return first.join(late, "id_atto", "outer").na.fill(0, ["n_primi", "n_tardi"])


FRAGMENTATION = """SELECT a.articolo_target AS num_clean, count(DISTINCT a.emendamento_id) AS num_emendamenti,
              count(DISTINCT p.proponente_gruppo) AS num_gruppi_coinvolti
       FROM amendments a LEFT JOIN proponents p ON a.emendamento_id = p.emendamento_id GROUP BY a.articolo_target"""


@query("j3_fragmentation", FRAGMENTATION, "amendments proponents")
def j3(t: Tables):
    return fragmentation(t.role("amendments"), t.role("proponents"))


GROWTH = """SELECT atto_id, num_clean, ddlpres, ddlmess, coalesce(ddlmess, 0) - coalesce(ddlpres, 0) AS delta_words FROM (
         SELECT atto_id, rtrim(replace(replace(numero_articolo, 'Art.', ''), ' ', ''), '.') AS num_clean,
                max(len(string_split_regex(testo_integrale, '\\s+'))) FILTER (versione = 'ddlpres') AS ddlpres,
                max(len(string_split_regex(testo_integrale, '\\s+'))) FILTER (versione = 'ddlmess') AS ddlmess
         FROM articles WHERE versione IN ('ddlpres', 'ddlmess') GROUP BY 1, 2)"""


@query(
    "j4_growth_by_article_number",
    f"""SELECT g.*, f.num_emendamenti, f.num_gruppi_coinvolti FROM ({GROWTH}) g LEFT JOIN ({FRAGMENTATION}) f ON g.num_clean = f.num_clean""",
    "articles amendments proponents",
)
def j4(t: Tables):
    return growth_vs_fragmentation(t.role("articles"), t.role("amendments"), t.role("proponents"))


ASOF = """SELECT d.sign_id, d.person_id, d.data_firma,
              CASE WHEN k.person_id IS NULL THEN NULL WHEN m.member_id IS NULL THEN 'Misto / Sconosciuto' ELSE m.gruppo END AS gruppo
       FROM dated d
       LEFT JOIN (SELECT DISTINCT person_id FROM memberships) k ON d.person_id = k.person_id
       LEFT JOIN (
         SELECT d.sign_id, m.member_id, m.gruppo, row_number() OVER (PARTITION BY d.sign_id ORDER BY m.member_id) AS rn
         FROM dated d JOIN memberships m ON d.person_id = m.person_id
          AND m.inizio <= d.data_firma AND (m.fine IS NULL OR m.fine >= d.data_firma)) m
         ON d.sign_id = m.sign_id AND m.rn = 1"""


def _asof(t):
    return asof_interval(t.role("dated"), t.role("memberships"), "person_id", "data_firma", "inizio", "fine", [F.col("member_id")], "gruppo")


@query("j5_asof_group", ASOF, "dated memberships")
def j5(t: Tables):
    return _asof(t)


@query(
    "j6_valid_name",
    """SELECT m.member_id, m.person_id, m.group_id, m.inizio, d.nome_gruppo FROM memberships m JOIN denominations d
       ON m.group_id = d.group_id AND d.dn_inizio <= m.inizio AND (d.dn_fine IS NULL OR d.dn_fine >= m.inizio)""",
    "memberships denominations",
)
def j6(t: Tables):
    m = t.role("memberships").select("member_id", "person_id", "group_id", "inizio")
    return valid_at(m, t.role("denominations"), "group_id", "inizio", "dn_inizio", "dn_fine").drop("dn_inizio", "dn_fine")


@query(
    "j7_multi_hop_chain",
    """SELECT s.id_atto, s.person_id, sup.s_name AS nome, n.n_name AS gruppo, r.r_name AS area
       FROM (SELECT DISTINCT id_atto, person_id FROM signatures WHERE is_primo) s
       JOIN supplier sup ON sup.s_suppkey = s.person_id JOIN nation n ON n.n_nationkey = sup.s_nationkey
       JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "signatures",
)
def j7(t: Tables):
    chain = graph.chain(t.role("triples"), ["nazione", "regione"], ["persona", "gruppo_uri", "area_uri"])
    names = t.role("triples").filter("p = 'nome'").select("s", "o").distinct()

    def named(df, key, out):
        return df.join(names.select(F.col("s").alias(key), F.col("o").alias(out)), key)

    people = chain.filter(F.startswith(F.col("persona"), F.lit("fornitore/")))
    for key, out in (("persona", "nome"), ("gruppo_uri", "gruppo"), ("area_uri", "area")):
        people = named(people, key, out)
    signed = t.role("signatures").filter("is_primo").select("id_atto", "person_id").distinct()
    signed = signed.withColumn("persona", F.concat(F.lit("fornitore/"), F.col("person_id")))
    return signed.join(people, "persona").select("id_atto", "person_id", "nome", "gruppo", "area")


COUNTS = """SELECT CAST(o.id_atto AS STRING) AS id_fase, count(DISTINCT a.emendamento_id) AS n_emendamenti,
              count(DISTINCT CASE WHEN a.has_akn THEN a.emendamento_id END) AS n_emendamenti_akn
       FROM amendments a JOIN acts o ON o.id_ddl = a.oggetto GROUP BY o.id_atto"""


def subjects(t):
    return t.role("acts").select(F.col("id_ddl").alias("oggetto"), F.col("id_atto").cast("string").alias("id_fase"))


@query("j8_amendment_subject_bill", COUNTS, "amendments acts")
def j8(t: Tables):
    return amendment_counts(t.role("amendments"), subjects(t), "has_akn")


@query("j9_anti_join", "SELECT id_atto, natura FROM acts ANTI JOIN signatures USING (id_atto)", "acts signatures")
def j9(t: Tables):
    signed = t.role("signatures").select("id_atto")
    return t.role("acts").select("id_atto", "natura").join(signed, "id_atto", "left_anti")


@query(
    "j10_semi_join_counts",
    """SELECT legislatura, count(*) AS n FROM acts SEMI JOIN (SELECT id_atto FROM signatures WHERE is_primo) x USING (id_atto) GROUP BY legislatura""",
    "acts signatures",
)
def j10(t: Tables):
    first = t.role("signatures").filter("is_primo").select("id_atto")
    return t.role("acts").join(first, "id_atto", "left_semi").groupBy("legislatura").agg(F.count("*").alias("n"))


@query(
    "j11_name_fallback",
    """SELECT id_atto, person_id, coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN concat(s_name, ' ', s_nationkey) END, concat('P', person_id)) AS nome
       FROM signatures LEFT JOIN supplier ON s_suppkey = person_id AND s_suppkey % 4 <> 0""",
    "signatures",
)
def j11(t: Tables):
    named = F.col("s_suppkey") % 3 != 0
    names = t("supplier").filter("s_suppkey % 4 <> 0").select(
        F.col("s_suppkey").alias("person_id"),
        F.when(named, F.col("s_name")).alias("first"),
        F.when(named, F.col("s_nationkey").cast("string")).alias("last"),
    )
    s = t.role("signatures").select("id_atto", "person_id", F.concat(F.lit("P"), F.col("person_id")).alias("nome"))
    return with_names(s, names, "person_id", "nome", "first", "last")


@query(
    "j12_groups_by_government",
    """SELECT g.legislatura, g.sigla, count(m.q) AS n_governi FROM groups_by_leg g LEFT JOIN majority m
       ON g.legislatura = m.legislatura AND g.sigla = m.sigla GROUP BY g.legislatura, g.sigla""",
    "groups_by_leg majority",
)
def j12(t: Tables):
    members = co.majority_members(t.role("governments"))
    joined = t.role("groups_by_leg").join(members, ["legislatura", "sigla"], "left")
    return joined.groupBy("legislatura", "sigla").agg(F.count("nome").alias("n_governi"))


@query(
    "j13_unknown_groups",
    """SELECT legislatura, nome, sigla FROM (
         SELECT m.legislatura, c.nome, m.sigla FROM majority m JOIN cabinets c ON m.legislatura = c.legislatura AND m.q = c.q
         UNION SELECT legislatura, nome, pm_gruppo FROM cabinets WHERE pm_gruppo IS NOT NULL) x
       ANTI JOIN groups_by_leg USING (legislatura, sigla)""",
    "majority cabinets groups_by_leg",
)
def j13(t: Tables):
    return co.unknown_groups(t.role("governments"), t.role("groups_by_leg"))


@query(
    "j14_amendment_date_by_subject",
    """SELECT a.emendamento_id, min(CAST(e.ts AS DATE)) AS data FROM amendments a JOIN events e
       ON e.user_id = a.oggetto AND e.event_type = 'purchase' GROUP BY a.emendamento_id""",
    "amendments",
)
def j14(t: Tables):
    votes = t("events").filter("event_type = 'purchase'")
    sessions = votes.select(F.col("event_id").alias("seduta"), F.col("ts").cast("date").alias("data"))
    return amendment_dates(
        t.role("amendments"), votes.select(F.col("event_id").alias("seduta"), F.col("user_id").alias("oggetto")), sessions
    )


@query(
    "j15_star_join",
    """SELECT a.legislatura, n.n_name AS gruppo, count(*) AS n_firme, sum(CASE WHEN m.sigla IS NOT NULL THEN 1 ELSE 0 END) AS n_maggioranza
       FROM acts a JOIN signatures s ON a.id_atto = s.id_atto JOIN supplier u ON u.s_suppkey = s.person_id
       JOIN nation n ON n.n_nationkey = u.s_nationkey
       LEFT JOIN (SELECT DISTINCT legislatura, sigla FROM majority WHERE q = 1) m
         ON m.legislatura = a.legislatura AND m.sigla = concat('N', n.n_nationkey)
       GROUP BY a.legislatura, n.n_name""",
    "acts signatures majority",
)
def j15(t: Tables):
    # Signatures fold to (legislature, person) before they meet the dimensions.
    acts = t.role("acts").select("id_atto", "legislatura")
    facts = t.role("signatures").select("id_atto", "person_id").join(acts, "id_atto")
    facts = facts.groupBy("legislatura", "person_id").agg(F.count("*").alias("n"))
    people = t("supplier").select(F.col("s_suppkey").alias("person_id"), F.col("s_nationkey").alias("n_nationkey"))
    dims = people.join(t("nation"), "n_nationkey").select(
        "person_id", F.col("n_name").alias("gruppo"), F.concat(F.lit("N"), F.col("n_nationkey")).alias("sigla")
    )
    side = t.role("majority").filter("q = 1").select("legislatura", "sigla").distinct().withColumn("m", F.lit(True))
    joined = facts.join(dims, "person_id").join(side, ["legislatura", "sigla"], "left")
    return joined.groupBy("legislatura", "gruppo").agg(
        F.sum("n").alias("n_firme"), F.sum(F.when(F.col("m"), F.col("n")).otherwise(0)).alias("n_maggioranza")
    )


@query(
    "j16_cross_chamber_link",
    """SELECT a.id_atto, t.altro_atto, b.natura AS altra_natura FROM acts a JOIN transmissions t ON a.id_atto = t.id_atto
       JOIN acts b ON b.id_atto = t.altro_atto WHERE a.ramo_origine = 'F' AND b.ramo_origine = 'O'""",
    "acts transmissions",
)
def j16(t: Tables):
    acts = t.role("acts")
    here = acts.filter("ramo_origine = 'F'").select("id_atto")
    there = acts.filter("ramo_origine = 'O'").select(F.col("id_atto").alias("altro_atto"), F.col("natura").alias("altra_natura"))
    return t.role("transmissions").join(here, "id_atto").join(there, "altro_atto")


@query(
    "j17_roles_with_names",
    """SELECT r.id_atto, r.person_id, r.ruolo, s_name AS nome FROM (
         SELECT DISTINCT id_atto, person_id, CASE WHEN is_primo THEN 'primo' ELSE 'altro' END AS ruolo FROM signatures) r
       LEFT JOIN supplier ON s_suppkey = r.person_id AND s_suppkey % 6 <> 0""",
    "signatures",
)
def j17(t: Tables):
    s, cols = t.role("signatures"), ["id_atto", "person_id"]
    roles = role_union(s.filter("is_primo").select(cols), s.filter("not is_primo").select(cols))
    names = t("supplier").filter("s_suppkey % 6 <> 0").select(F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("nome"))
    return roles.join(names, "person_id", "left")


@query(
    "j18_signatures_with_group",
    """SELECT s.id_atto, s.person_id, s.sign_id, m.gruppo FROM signatures s LEFT JOIN (
         SELECT person_id, gruppo FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY inizio DESC, gruppo) AS rn FROM memberships)
         WHERE rn = 1) m ON s.person_id = m.person_id""",
    "signatures memberships",
)
def j18(t: Tables):
    s = t.role("signatures").select("id_atto", "person_id", "sign_id")
    return with_groups(s, t.role("memberships"), "person_id", "inizio", ["gruppo"])


@query(
    "j19_phases_of_bills",
    """SELECT e.event_id AS id_iter, e.user_id AS id_ddl, l.legislatura FROM events e
       JOIN (SELECT DISTINCT id_ddl, legislatura FROM acts) l ON l.id_ddl = e.user_id WHERE e.event_type = 'click'""",
    "acts",
)
def j19(t: Tables):
    iters = t("events").filter("event_type = 'click'").select(F.col("event_id").alias("id_iter"), F.col("user_id").alias("id_ddl"))
    return phases_of_bills(iters, t.role("acts"), "id_ddl")


@query(
    "j20_act_debate_attachment",
    """SELECT DISTINCT concat('cliente/', c_custkey) AS atto, concat('nazione/', n_nationkey) AS dibattito,
              concat('regione/', r_regionkey) AS discussione, r_name AS allegato
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def j20(t: Tables):
    nodes = ["atto", "dibattito", "discussione", "allegato"]
    rows = graph.chain(t.role("triples"), ["nazione", "regione", "nome"], nodes)
    return rows.filter(F.startswith(F.col("atto"), F.lit("cliente/")))


@query(
    "j21_short_long_names",
    """SELECT sigla, titolo FROM (SELECT p_brand AS sigla, p_name AS titolo, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) AS rn
         FROM part WHERE p_partkey % 3 <> 0) WHERE rn = 1""",
)
def j21(t: Tables):
    groups = t("part").select(
        F.col("p_partkey").alias("uri"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("titolo"),
        F.col("p_brand").alias("sigla"),
    )
    return co.group_names(groups, "uri", "titolo", "sigla")


@query(
    "t13_coalition_side",
    f"""SELECT a.sign_id, a.gruppo, CASE WHEN a.gruppo IS NULL OR a.data_firma IS NULL THEN NULL
              WHEN EXISTS (SELECT 1 FROM memberships w WHERE w.gruppo IN ('G1', 'G3', 'G7') AND w.gruppo = a.gruppo AND w.inizio <= a.data_firma
                           AND (w.fine IS NULL OR w.fine >= a.data_firma)) THEN 'maggioranza' ELSE 'opposizione' END AS schieramento
       FROM ({ASOF}) a""",
    "dated memberships",
)
def t13(t: Tables):
    majorities = t.role("memberships").filter("gruppo in ('G1', 'G3', 'G7')").select("gruppo", "inizio", "fine")
    return coalition_side(_asof(t), majorities, "gruppo", "data_firma").select("sign_id", "gruppo", "schieramento")


COALITIONS = f"""SELECT g.legislatura, g.sigla AS pol_party, g.sigla,
         coalesce(m.giorni, 0) AS giornialgoverno, coalesce(m.n, 0) AS governo, coalesce(p.giorni, 0) AS giornipm,
         CASE WHEN p.giorni IS NULL THEN 0 ELSE 1 END AS primoministro, coalesce(m.nomi, '') AS governo_nome,
         CASE WHEN coalesce(m.giorni, 0) > 0 THEN 1 ELSE 0 END AS maggioranza
       FROM groups_by_leg g
       LEFT JOIN (SELECT j.legislatura, j.sigla, count(*) AS n,
                    CAST(sum(greatest(0, date_diff('day', c.inizio, coalesce(c.fine, DATE '{AS_OF}')))) AS BIGINT) AS giorni,
                    string_agg(c.nome, ';' ORDER BY c.inizio, c.nome) AS nomi
                  FROM majority j JOIN cabinets c ON j.legislatura = c.legislatura AND j.q = c.q GROUP BY j.legislatura, j.sigla) m
         ON g.legislatura = m.legislatura AND g.sigla = m.sigla
       LEFT JOIN (SELECT legislatura, pm_gruppo AS sigla,
                    CAST(sum(greatest(0, date_diff('day', inizio, coalesce(fine, DATE '{AS_OF}')))) AS BIGINT) AS giorni
                  FROM cabinets WHERE pm_gruppo IS NOT NULL GROUP BY legislatura, pm_gruppo) p
         ON g.legislatura = p.legislatura AND g.sigla = p.sigla"""


def _coalitions(t):
    return co.coalitions(t.role("governments"), t.role("groups_by_leg"), AS_OF)


@query("a21_coalition_tenure", COALITIONS, "groups_by_leg majority cabinets")
def a21(t: Tables):
    return _coalitions(t)


@query("d8_coalitions", COALITIONS, "groups_by_leg majority cabinets")
def d8(t: Tables):
    return _coalitions(t)


@query(
    "a30_side_totals",
    f"""SELECT legislatura, count(*) AS n_gruppi, count(*) FILTER (maggioranza = 1) AS n_maggioranza, count(*) FILTER (maggioranza <> 1) AS n_opposizione
       FROM ({COALITIONS}) GROUP BY ROLLUP (legislatura)""",
    "groups_by_leg majority cabinets",
)
def a30(t: Tables):
    return co.side_totals(_coalitions(t))


@query(
    "a29_majority_share",
    """WITH per AS (SELECT a.atto_id, a.emendamento_id, coalesce(bool_or(p.proponente_gruppo IN ('G1', 'G3', 'G7')), false) AS mag
         FROM amendments a LEFT JOIN proponents p ON a.emendamento_id = p.emendamento_id GROUP BY 1, 2)
       SELECT atto_id, count(*) AS n_emend, count(*) FILTER (mag) AS n_emend_mag,
              round_even(CAST(count(*) FILTER (mag) AS DOUBLE) * 100.0 / count(*), 1) AS pct_emend_maggioranza FROM per GROUP BY atto_id""",
    "amendments proponents",
)
def a29(t: Tables):
    side = F.when(F.col("proponente_gruppo").isin("G1", "G3", "G7"), "maggioranza").otherwise("opposizione")
    p = t.role("proponents").select("emendamento_id", side.alias("schieramento")).distinct()
    rows = t.role("amendments").select("atto_id", "emendamento_id").join(p, "emendamento_id", "left")
    return co.majority_share(rows, "atto_id", "emendamento_id", "schieramento")


@query(
    "a28_bill_measures",
    """SELECT s.id_atto, count(DISTINCT s.person_id) AS n_firmatari, count(DISTINCT CASE WHEN s.person_id % 10 <> 0 THEN concat('G', s.person_id % 25) END) AS n_gruppi_firmatari
       FROM signatures s GROUP BY s.id_atto""",
    "signatures",
)
def a28(t: Tables):
    group = F.when(F.col("person_id") % 10 != 0, F.concat(F.lit("G"), F.col("person_id") % 25))
    return co.bill_measures(t.role("signatures").withColumn("gruppo", group), "id_atto", "person_id", "gruppo")


@query(
    "a1_counts_per_key",
    "SELECT natura, count(*) AS n, count(DISTINCT id_ddl) AS n_ddl, count(*) FILTER (importo > 200000) AS n_grandi FROM acts GROUP BY natura",
    "acts",
)
def a1(t: Tables):
    return t.role("acts").groupBy("natura").agg(
        F.count("*").alias("n"), F.countDistinct("id_ddl").alias("n_ddl"), count_if(F.col("importo") > 200000).alias("n_grandi")
    )
