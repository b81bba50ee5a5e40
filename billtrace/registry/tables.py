"""Whole tables built by the plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coalitions as co
from ..plans import (
    analytic_star,
    bill_profile,
    chamber_acts,
    chamber_coverage,
    chamber_signers,
    complexity_table,
    growth_report,
    senate_bills,
    senate_coverage,
    senate_signers,
    state_history,
)
from ..plans.senate import bill_phases
from .aggregates import PHASE_PIVOT, PHASE_SUMMARY
from .base import Tables, pct, query
from .joins import COALITIONS, COUNTS, FRAGMENTATION, GROWTH, subjects
from .texts import BAND, COUNTS as TEXT_COUNTS, REFERENCES, SCORE, SENTENCES

SIGNERS = """SELECT i.id_fase, i.legislatura, i.uri_iniziativa, i.is_primo_firmatario, i.uri_senatore,
         coalesce(nullif(concat_ws(' ', p.nome, p.cognome), ''), i.nome_senatore) AS nome_senatore,
         i.tipo_iniziativa, i.data_firma, i.data_ritiro_firma, g.gruppo_uri, g.gruppo_nome, g.gruppo_sigla, g.carica_gruppo
       FROM (SELECT *, coalesce(primo_firmatario = '1', false) AS is_primo_firmatario, row_number() OVER (PARTITION BY id_fase, uri_iniziativa
              ORDER BY uri_senatore NULLS FIRST, nome_senatore, tipo_iniziativa, data_firma) AS rn FROM initiatives) i
       LEFT JOIN people p ON p.senatore = i.uri_senatore
       LEFT JOIN (SELECT concat('senatore/', m.person_id) AS uri_senatore, concat('gruppo/', m.group_id) AS gruppo_uri, d.nome_gruppo AS gruppo_nome,
                    concat('S', m.group_id) AS gruppo_sigla, 'Membro' AS carica_gruppo,
                    row_number() OVER (PARTITION BY m.person_id ORDER BY m.inizio DESC, concat('gruppo/', m.group_id), d.nome_gruppo) AS rn
                  FROM memberships m JOIN (SELECT *, min(nome_gruppo) OVER (PARTITION BY group_id) AS k FROM denominations) d
                    ON m.group_id = d.group_id AND d.dn_inizio <= m.inizio AND (d.dn_fine IS NULL OR d.dn_fine >= m.inizio)) g
         ON g.uri_senatore = i.uri_senatore AND g.rn = 1
       WHERE i.rn = 1"""
SIGNER_ROLES = "initiatives people memberships denominations"


def _signers(t):
    m = t.role("memberships")
    memberships = m.select(
        F.concat(F.lit("senatore/"), F.col("person_id")).alias("uri_senatore"),
        F.concat(F.lit("gruppo/"), F.col("group_id")).alias("gruppo_uri"),
        F.lit("Membro").alias("carica_gruppo"),
        F.col("inizio").alias("adGInizio"),
        F.col("fine").alias("adGFine"),
    )
    d = t.role("denominations")
    denominations = d.select(
        F.concat(F.lit("gruppo/"), F.col("group_id")).alias("gruppo_uri"),
        F.col("nome_gruppo").alias("gruppo_nome"),
        F.concat(F.lit("S"), F.col("group_id")).alias("gruppo_sigla"),
        F.col("dn_inizio").alias("dnInizio"),
        F.col("dn_fine").alias("dnFine"),
    )
    people = t.role("people").withColumnRenamed("senatore", "uri_senatore")
    return senate_signers(t.role("initiatives"), people, memberships, denominations)


@query("d2_senate_signers", SIGNERS, SIGNER_ROLES)
def d2(t: Tables):
    return _signers(t)


BILLS = f"""SELECT b.id_fase, b.legislatura, b.progressivo_iter, b.is_prima_fase, b.ramo_origine, b.natura, b.has_testo_presentato, b.has_testo_approvato,
         coalesce(c.n_emendamenti, 0) AS n_emendamenti, coalesce(c.n_emendamenti_akn, 0) AS n_emendamenti_akn,
         coalesce(c.n_emendamenti, 0) > 0 AS has_emendamenti, coalesce(c.n_emendamenti_akn, 0) > 0 AS has_emendamenti_akn,
         f.tipo_iniziativa, f.uri_primo_firmatario, f.nome_primo_firmatario, f.gruppo_primo_firmatario_uri,
         f.gruppo_primo_firmatario_nome, f.gruppo_primo_firmatario_sigla, coalesce(k.n_co, 0) AS n_cofirmatari, coalesce(k.n_tot, 0) AS n_cofirmatari_totale,
         'sparql:dati.senato.it' AS fonte
       FROM phases b LEFT JOIN ({COUNTS}) c ON c.id_fase = b.id_fase
       LEFT JOIN (SELECT id_fase, arg_min(tipo_iniziativa, uri_iniziativa) FILTER (tipo_iniziativa IS NOT NULL) AS tipo_iniziativa,
                    arg_min(uri_senatore, uri_iniziativa) FILTER (uri_senatore IS NOT NULL) AS uri_primo_firmatario,
                    arg_min(nome_senatore, uri_iniziativa) FILTER (nome_senatore IS NOT NULL) AS nome_primo_firmatario,
                    arg_min(gruppo_uri, uri_iniziativa) FILTER (gruppo_uri IS NOT NULL) AS gruppo_primo_firmatario_uri,
                    arg_min(gruppo_nome, uri_iniziativa) FILTER (gruppo_nome IS NOT NULL) AS gruppo_primo_firmatario_nome,
                    arg_min(gruppo_sigla, uri_iniziativa) FILTER (gruppo_sigla IS NOT NULL) AS gruppo_primo_firmatario_sigla
                  FROM ({SIGNERS}) WHERE is_primo_firmatario GROUP BY id_fase) f ON f.id_fase = b.id_fase
       LEFT JOIN (SELECT id_fase, count(*) FILTER (NOT is_primo_firmatario AND uri_senatore IS NOT NULL) AS n_co,
                    count(*) FILTER (NOT is_primo_firmatario) AS n_tot FROM ({SIGNERS}) GROUP BY id_fase) k ON k.id_fase = b.id_fase"""
BILL_ROLES = f"phases amendments acts {SIGNER_ROLES}"
BILL_COLUMNS = [
    "id_fase", "legislatura", "progressivo_iter", "is_prima_fase", "ramo_origine", "natura", "has_testo_presentato", "has_testo_approvato",
    "n_emendamenti", "n_emendamenti_akn", "has_emendamenti", "has_emendamenti_akn", "tipo_iniziativa", "uri_primo_firmatario",
    "nome_primo_firmatario", "gruppo_primo_firmatario_uri", "gruppo_primo_firmatario_nome", "gruppo_primo_firmatario_sigla",
    "n_cofirmatari", "n_cofirmatari_totale", "fonte",
]


def _bills(t):
    raw = t.role("phases").select(
        F.concat(F.lit("http://ddl/"), F.col("id_fase"), F.lit("/")).alias("uri_ddl"),
        "legislatura",
        F.col("progressivo_iter").cast("string").alias("prog_iter"),
        "ramo_origine",
        "natura",
        F.when(F.col("has_testo_presentato"), F.lit("urn:a")).alias("urn_testo_presentato"),
        F.when(F.col("has_testo_approvato"), F.lit("urn:b")).alias("urn_testo_approvato"),
    )
    return senate_bills(bill_phases(raw), t.role("amendments"), subjects(t), _signers(t))


@query("d1_senate_bills", BILLS, BILL_ROLES)
def d1(t: Tables):
    return _bills(t).select(BILL_COLUMNS)


@query(
    "d3_senate_coverage",
    f"""SELECT legislatura, ramo_origine, count(*) AS n_ddl, count(*) FILTER (has_testo_presentato) AS n_con_testo_presentato,
              count(*) FILTER (has_emendamenti) AS n_con_emendamenti, count(*) FILTER (has_emendamenti_akn) AS n_con_emendamenti_akn,
              count(uri_primo_firmatario) AS n_con_primo_firmatario, CAST(sum(n_emendamenti) AS BIGINT) AS n_emendamenti_totali,
              {pct("count(*) FILTER (has_testo_presentato)", "count(*)")} AS pct_testo_presentato,
              {pct("count(*) FILTER (has_emendamenti_akn)", "count(*)")} AS pct_emendamenti_akn,
              {pct("count(uri_primo_firmatario)", "count(*)")} AS pct_primo_firmatario
       FROM ({BILLS}) GROUP BY legislatura, ramo_origine""",
    BILL_ROLES,
)
def d3(t: Tables):
    return senate_coverage(_bills(t))


CHAMBER_SIGNERS = """SELECT string_split(r.atto, '/')[-1] AS id_atto, r.legislatura, r.dep AS uri_deputato,
         nullif(concat_ws(' ', p.nome, p.cognome), '') AS nome_deputato, r.is_primo_firmatario, g.gruppo_uri, g.gruppo_nome, g.gruppo_sigla
       FROM (SELECT atto, legislatura, dep, bool_or(l_linenumber = 1) AS is_primo_firmatario FROM chamber_lines GROUP BY ALL) r
       LEFT JOIN people p ON replace(p.senatore, 'senatore', 'dep') = r.dep
       LEFT JOIN (SELECT concat('dep/', person_id) AS dep, concat('gruppo/', group_id) AS gruppo_uri, gruppo AS gruppo_nome, concat('S', group_id) AS gruppo_sigla,
                    row_number() OVER (PARTITION BY person_id ORDER BY inizio DESC, concat('gruppo/', group_id), gruppo) AS rn FROM memberships WHERE person_id % 9 <> 0) g
         ON g.dep = r.dep AND g.rn = 1"""
CHAMBER_ROLES = "chamber_lines people memberships"


def _chamber_signers(t):
    lines = t.role("chamber_lines")
    cols = ["atto", "legislatura", "dep"]
    names = t.role("people").select(F.replace("senatore", F.lit("senatore"), F.lit("dep")).alias("dep"), "nome", "cognome")
    blank = F.when(F.col("person_id") % 9 == 0, "nodeID://").otherwise("dep/")
    memberships = t.role("memberships").select(
        F.concat(blank, F.col("person_id")).alias("uri_deputato"),
        F.col("inizio").alias("start"),
        F.concat(F.lit("gruppo/"), F.col("group_id")).alias("gruppo_uri"),
        F.col("gruppo").alias("gruppo_nome"),
        F.concat(F.lit("S"), F.col("group_id")).alias("gruppo_sigla"),
    )
    first, others = lines.filter("l_linenumber = 1").select(cols), lines.filter("l_linenumber <> 1").select(cols)
    return chamber_signers(first, others, names, memberships)


@query("d5_chamber_signers", CHAMBER_SIGNERS, CHAMBER_ROLES)
def d5(t: Tables):
    return _chamber_signers(t)


LABELS = "CASE l_returnflag WHEN 'A' THEN 'Da assegnare' WHEN 'R' THEN 'Approvato definitivamente. Legge' END"
HISTORY = f"""SELECT atto, string_split(atto, '/')[-1] AS id_atto, legislatura, stato_uri, si_label, giorno AS si_date FROM (
         SELECT atto, legislatura, concat('stato/', l_linenumber) AS stato_uri, {LABELS} AS si_label, giorno,
           row_number() OVER (PARTITION BY atto, l_linenumber ORDER BY {LABELS} NULLS FIRST, giorno) AS rn FROM chamber_lines) WHERE rn = 1"""


def _states(t):
    flag = F.col("l_returnflag")
    label = F.when(flag == "A", "Da assegnare").when(flag == "R", "Approvato definitivamente. Legge")
    return t.role("chamber_lines").select(
        "atto", "legislatura", F.concat(F.lit("stato/"), F.col("l_linenumber")).alias("stato"), label.alias("si_label"),
        F.date_format("giorno", "yyyyMMdd").alias("si_date"),
    )


@query("d7_state_history", f"SELECT id_atto, legislatura, stato_uri, si_label, si_date FROM ({HISTORY})", "chamber_lines")
def d7(t: Tables):
    return state_history(_states(t))


ACTS = f"""SELECT string_split(a.atto, '/')[-1] AS id_atto, try_cast(a.id AS INTEGER) AS id_numerico, a.legislatura, a.titolo,
         coalesce(v.giorno, make_date(a.legislatura, 1, 5)) AS data_presentazione, a.tipo AS tipo_atto, k.natura, a.iniziativa,
         s.primo_firmatario_uri, s.primo_firmatario_nome, s.n_cofirmatari, w.si_label AS stato_iter, w.giorno AS data_stato_iter,
         d.data_prima_assegnazione, d.data_approvazione, v.url AS url_testo_presentato, v.url IS NOT NULL AS has_testo, a.url_scheda_camera,
         'sparql:dati.camera.it' AS fonte
       FROM chamber_acts a
       LEFT JOIN (SELECT atto, natura FROM (SELECT atto, CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS STRING) ELSE concat('Natura ', l_partkey) END AS natura,
                    row_number() OVER (PARTITION BY atto ORDER BY concat('http://natura/', l_partkey)) AS rn FROM chamber_lines) WHERE rn = 1) k ON k.atto = a.atto
       LEFT JOIN (SELECT atto, si_label, giorno FROM (SELECT atto, {LABELS} AS si_label, giorno,
                    row_number() OVER (PARTITION BY atto ORDER BY giorno DESC, {LABELS} DESC NULLS LAST) AS rn FROM chamber_lines) WHERE rn = 1) w ON w.atto = a.atto
       LEFT JOIN (SELECT atto, giorno, url FROM (SELECT atto, giorno, CASE WHEN l_partkey % 4 <> 0 THEN concat('http://testo/', l_partkey) END AS url,
                    row_number() OVER (PARTITION BY atto ORDER BY giorno, CASE WHEN l_partkey % 4 <> 0 THEN concat('http://testo/', l_partkey) END NULLS FIRST) AS rn
                    FROM chamber_lines WHERE l_linestatus = 'O') WHERE rn = 1) v ON v.atto = a.atto
       LEFT JOIN (SELECT id_atto, min(uri_deputato) FILTER (is_primo_firmatario) AS primo_firmatario_uri,
                    arg_min(nome_deputato, uri_deputato) FILTER (is_primo_firmatario) AS primo_firmatario_nome,
                    count(DISTINCT CASE WHEN NOT is_primo_firmatario THEN uri_deputato END) AS n_cofirmatari
                  FROM ({CHAMBER_SIGNERS}) GROUP BY id_atto) s ON s.id_atto = string_split(a.atto, '/')[-1]
       LEFT JOIN (SELECT id_atto, min(si_date) FILTER (si_label = 'Da assegnare') AS data_prima_assegnazione,
                    min(si_date) FILTER (si_label = 'Approvato definitivamente. Legge') AS data_approvazione
                  FROM ({HISTORY}) WHERE si_label IS NOT NULL GROUP BY id_atto) d ON d.id_atto = string_split(a.atto, '/')[-1]"""
ACT_ROLES = f"chamber_acts {CHAMBER_ROLES}"


def _chamber_acts(t):
    lines = t.role("chamber_lines")
    kinds = lines.select(
        "atto",
        F.concat(F.lit("http://natura/"), F.col("l_partkey")).alias("natura_uri"),
        F.when(F.col("l_partkey") % 3 != 0, F.concat(F.lit("Natura "), F.col("l_partkey"))).alias("natura_label"),
    )
    versions = lines.filter("l_linestatus = 'O'").select(
        "atto",
        F.date_format("giorno", "yyyyMMdd").alias("vta_date"),
        F.when(F.col("l_partkey") % 4 != 0, F.concat(F.lit("http://testo/"), F.col("l_partkey"))).alias("vta_url"),
    )
    return chamber_acts(t.role("chamber_acts"), kinds, _states(t), versions, _chamber_signers(t))


@query("d4_chamber_acts", ACTS, ACT_ROLES)
def d4(t: Tables):
    return _chamber_acts(t).drop("data_fetch")


@query(
    "d6_chamber_coverage",
    f"""SELECT legislatura, count(*) AS n_atti, count(*) FILTER (has_testo) AS n_has_testo, count(natura) AS n_has_natura, count(stato_iter) AS n_has_stato,
              count(primo_firmatario_uri) AS n_has_primo_firmatario, count(*) FILTER (n_cofirmatari > 0) AS n_has_cofirmatari,
              count(data_prima_assegnazione) AS n_has_data_assegnazione, count(data_approvazione) AS n_has_data_approvazione,
              {pct("count(*) FILTER (has_testo)", "count(*)")} AS pct_has_testo, {pct("count(natura)", "count(*)")} AS pct_has_natura,
              {pct("count(stato_iter)", "count(*)")} AS pct_has_stato, {pct("count(primo_firmatario_uri)", "count(*)")} AS pct_has_primo_firmatario,
              {pct("count(data_prima_assegnazione)", "count(*)")} AS pct_has_data_assegnazione,
              {pct("count(data_approvazione)", "count(*)")} AS pct_has_data_approvazione
       FROM ({ACTS}) GROUP BY legislatura""",
    ACT_ROLES,
)
def d6(t: Tables):
    return chamber_coverage(_chamber_acts(t))


@query(
    "d11_growth_report",
    f"""SELECT g.*, f.num_emendamenti, f.num_gruppi_coinvolti FROM ({GROWTH}) g LEFT JOIN ({FRAGMENTATION}) f ON g.num_clean = f.num_clean
       ORDER BY delta_words DESC, atto_id, num_clean""",
    "articles amendments proponents",
)
def d11(t: Tables):
    return growth_report(t.role("articles"), t.role("amendments"), t.role("proponents"))


def _star(t):
    signers = t.role("initiatives").select(
        "id_fase",
        (F.col("legislatura") + 1982).alias("legislatura"),
        "uri_iniziativa",
        F.concat(F.lit("gruppo/"), F.length("nome_senatore"), F.lit("-"), F.right("nome_senatore", F.lit(1))).alias("gruppo_uri"),
        F.concat(F.lit("N"), F.right("nome_senatore", F.lit(1))).alias("gruppo_sigla"),
    )
    coalition = co.coalitions(t.role("governments"), t.role("groups_by_leg"), "2001-01-01")
    return analytic_star(t.role("phases"), signers, coalition)


@query(
    "d14_star_bills",
    """SELECT b.id_fase, b.legislatura, CAST(date_diff('day', data_presentazione, data_stato_ddl) AS INTEGER) AS giorni_iter,
              coalesce(m.n_f, 0) AS n_firmatari, coalesce(m.n_g, 0) AS n_gruppi_firmatari,
              CAST(sum(b.n_emendamenti) OVER (PARTITION BY b.legislatura) AS BIGINT) AS n_emendamenti_per_leg,
              coalesce(contains(natura, 'DL'), false) OR descr_iniziativa = 'Governativa' AS is_governativo
       FROM phases b LEFT JOIN (SELECT id_fase, count(DISTINCT uri_iniziativa) AS n_f,
         count(DISTINCT concat('gruppo/', length(nome_senatore), '-', right(nome_senatore, 1))) AS n_g FROM initiatives GROUP BY id_fase) m ON m.id_fase = b.id_fase""",
    "phases initiatives",
)
def d14(t: Tables):
    return _star(t)["t_atti_senato"].select(
        "id_fase", "legislatura", "giorni_iter", "n_firmatari", "n_gruppi_firmatari", "n_emendamenti_per_leg", "is_governativo"
    )


@query(
    "d14_star_signatures",
    f"""SELECT i.id_fase, i.uri_iniziativa, concat('N', right(nome_senatore, 1)) AS gruppo_sigla, c.maggioranza AS in_maggioranza
       FROM initiatives i LEFT JOIN ({COALITIONS}) c ON c.legislatura = i.legislatura + 1982 AND c.sigla = concat('N', right(nome_senatore, 1))""",
    "initiatives groups_by_leg majority cabinets",
)
def d14_signatures(t: Tables):
    return _star(t)["t_firmatari_senato"].select("id_fase", "uri_iniziativa", "gruppo_sigla", "in_maggioranza")


@query(
    "d15_complexity_table",
    f"""SELECT conv_id, n_caratteri, n_parole, n_frasi, n_lettere, n_riferimenti_normativi, n_articoli, n_commi,
              round(n_caratteri / CAST(n_articoli AS DOUBLE), 4) AS lunghezza_media_articolo, round(g, 4) AS gulpease, {BAND} AS fascia, 'senato' AS fonte
       FROM (SELECT *, {SCORE} AS g FROM (SELECT conv_id, CAST(sum(n_caratteri) AS BIGINT) AS n_caratteri, CAST(sum(w) AS BIGINT) AS n_parole,
                CAST(sum(s) AS BIGINT) AS n_frasi, CAST(sum(l) AS BIGINT) AS n_lettere, CAST(sum(rif) AS BIGINT) AS n_riferimenti_normativi, count(*) AS n_articoli,
                CAST(sum(commi) AS BIGINT) AS n_commi, sum(w) AS w, sum(s) AS s, sum(l) AS l
              FROM (SELECT *, {SENTENCES} AS s FROM (SELECT conv_id, length(text) AS n_caratteri, len(string_split(text, chr(10))) AS commi,
                {REFERENCES.format(c="text")} AS rif, {TEXT_COUNTS.format(c="text")} FROM conversations)) GROUP BY conv_id))""",
)
def d15(t: Tables):
    articles = t("conversations").select("conv_id", "text", F.split("text", "\n").alias("commi"))
    out = complexity_table(articles, "conv_id", "text", "commi", "senato")
    rounded = {c: F.round(c, 4) for c in ("gulpease", "lunghezza_media_articolo")}
    return out.withColumns(rounded)


@query(
    "d16_bill_profile",
    f"""SELECT s.*, p.iter_1, p.iter_2, p.iter_3, p.iter_4 FROM ({PHASE_SUMMARY}) s JOIN ({PHASE_PIVOT}) p ON s.legislatura = p.legislatura""",
    "phases",
)
def d16(t: Tables):
    profile = bill_profile(t.role("phases"), [1, 2, 3, 4])
    return profile["summary"].join(profile["pivot"], "legislatura")
