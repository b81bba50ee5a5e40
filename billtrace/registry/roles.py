"""Roles the driver tables play: which columns stand for acts, signatures, memberships and so on.

The texts are plain projections that Spark and the checking engine both read, so both sides
start from the same rows. Three roles need functions the dialects spell differently and are
built with the DataFrame API.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLE_SQL = {
    "acts": """
        SELECT o_orderkey AS id_atto, CAST(year(o_orderdate) AS INTEGER) AS legislatura,
               CAST(o_orderdate AS DATE) AS data_presentazione, o_orderstatus AS ramo_origine,
               o_orderpriority AS natura, o_custkey AS id_ddl, o_totalprice AS importo
        FROM orders""",
    "signatures": """
        SELECT l_orderkey AS id_atto, l_suppkey AS person_id, l_linenumber = 1 AS is_primo,
               CAST(l_shipdate AS DATE) AS data_firma, l_partkey AS sign_id
        FROM lineitem""",
    "phases": """
        SELECT CAST(o_orderkey AS STRING) AS id_fase, o_custkey AS id_ddl_interno,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL
                    WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey + 1 AS STRING)
                    ELSE CAST(o_orderkey AS STRING) END AS id_fase_sparql,
               CAST(year(o_orderdate) AS INTEGER) AS legislatura,
               CAST(o_orderkey % 3 + 1 AS INTEGER) AS progressivo_iter,
               o_orderkey % 3 = 0 AS is_prima_fase,
               CASE o_orderstatus WHEN 'F' THEN 'S' WHEN 'O' THEN 'C' END AS ramo_origine,
               o_totalprice > 150000 AS has_testo_presentato,
               o_totalprice > 250000 AS has_testo_approvato,
               o_orderkey % 7 = 0 AS has_emendamenti,
               CAST(o_orderkey % 11 AS INTEGER) AS n_emendamenti,
               CAST(o_orderdate AS DATE) AS data_presentazione,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS data_stato_ddl,
               CASE WHEN o_orderkey % 9 = 0 THEN 'DDL costituzionale' WHEN o_orderkey % 9 = 1 THEN 'DL'
                    WHEN o_orderkey % 9 = 2 THEN NULL ELSE o_orderpriority END AS natura,
               CASE WHEN o_orderkey % 6 = 0 THEN 'Governativa' ELSE 'Parlamentare' END AS descr_iniziativa
        FROM orders""",
    "memberships": """
        SELECT user_id AS person_id, event_id AS member_id, CAST(ts AS DATE) AS inizio,
               CASE WHEN event_id % 5 = 0 THEN NULL
                    ELSE CAST(ts AS DATE) + CAST(event_id % 11 AS INTEGER) END AS fine,
               CAST(event_id % 25 AS INTEGER) AS group_id, concat('G', event_id % 25) AS gruppo
        FROM events WHERE event_type = 'signup'""",
    "denominations": """
        SELECT n_nationkey AS group_id, concat(n_name, ' prima') AS nome_gruppo,
               DATE '2024-01-01' AS dn_inizio, DATE '2024-01-15' AS dn_fine
        FROM nation
        UNION ALL
        SELECT n_nationkey, concat(n_name, ' poi'), DATE '2024-01-15', CAST(NULL AS DATE)
        FROM nation WHERE n_nationkey % 5 <> 0""",
    "dated": """
        SELECT event_id AS sign_id,
               user_id + CASE WHEN event_id % 17 = 0 THEN 1000000 ELSE 0 END AS person_id,
               CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS data_firma
        FROM events WHERE event_type = 'purchase'""",
    "amendments": """
        SELECT event_id AS emendamento_id, concat('A', user_id) AS atto_id, user_id AS oggetto,
               CAST(event_id % 4 + 1 AS STRING) AS articolo_target, CAST(ts AS DATE) AS data,
               value > 50 AS has_akn
        FROM events WHERE event_type = 'view'""",
    "proponents": """
        SELECT l_orderkey AS emendamento_id, l_suppkey AS proponente_id,
               CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE concat('G', l_suppkey % 25) END AS proponente_gruppo
        FROM lineitem""",
    "articles": """
        SELECT concat('A', conv_id) AS atto_id, concat('art', turn) AS articolo_id,
               concat('Art. ', CAST(floor(turn / 2) + 1 AS INTEGER), '.') AS numero_articolo,
               CASE role WHEN 'user' THEN 'ddlpres' WHEN 'assistant' THEN 'ddlmess' ELSE 'ddlcomm' END AS versione,
               text AS testo_integrale
        FROM conversations""",
    "states": """
        SELECT l_orderkey AS id_atto, CAST(l_linenumber AS STRING) AS stato,
               CASE l_returnflag WHEN 'A' THEN 'Da assegnare' WHEN 'R' THEN 'Approvato definitivamente. Legge'
                    ELSE 'In corso' END AS si_label,
               CAST(l_shipdate AS DATE) AS si_date
        FROM lineitem""",
    "history": """
        SELECT user_id AS id_atto, event_type AS stato, CAST(ts AS DATE) AS data, event_id AS posizione, value AS peso
        FROM events""",
    "paths": """
        SELECT concat('data/Leg', year(o_orderdate), '/Atto', o_custkey,
                      CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE concat('/',
                        CASE o_orderkey % 9 WHEN 0 THEN 'ddlpres' WHEN 1 THEN 'ddlcomm' WHEN 2 THEN 'ddlmess'
                             WHEN 3 THEN 'emend' WHEN 4 THEN 'emendc' WHEN 5 THEN 'resaula' WHEN 6 THEN 'sommcomm'
                             WHEN 7 THEN 'README.md' ELSE 'altro' END) END,
                      CASE WHEN o_orderkey % 23 = 0 OR o_orderkey % 9 = 7 THEN ''
                           WHEN o_orderkey % 2 = 0 THEN concat('/', o_orderkey, '.akn.xml')
                           ELSE concat('/', o_orderkey, '.txt') END) AS path
        FROM orders""",
    "majority": """
        SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS legislatura,
               CAST(quarter(o_orderdate) AS INTEGER) AS q, concat('N', o_custkey % 30) AS sigla
        FROM orders WHERE (o_custkey % 30 + quarter(o_orderdate)) % 3 = 0""",
    "cabinets": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS legislatura, CAST(quarter(o_orderdate) AS INTEGER) AS q,
               concat('Governo ', year(o_orderdate), '-', quarter(o_orderdate)) AS nome,
               min(CAST(o_orderdate AS DATE)) AS inizio,
               CASE WHEN year(o_orderdate) % 3 = 0 AND quarter(o_orderdate) = 4 THEN NULL
                    ELSE max(CAST(o_orderdate AS DATE)) END AS fine,
               CASE WHEN quarter(o_orderdate) = 4 THEN NULL
                    ELSE concat('N', quarter(o_orderdate) * 9) END AS pm_gruppo
        FROM orders GROUP BY year(o_orderdate), quarter(o_orderdate)""",
    "groups_by_leg": """
        SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS legislatura, concat('N', o_custkey % 25) AS sigla
        FROM orders""",
    "transmissions": """
        SELECT DISTINCT l_orderkey AS id_atto, l_partkey AS altro_atto FROM lineitem WHERE l_linenumber = 2""",
    "texts": """
        SELECT doc_id, concat('Sostituire l''articolo ', doc_id % 9 + 1, ' comma ', doc_id % 4 + 1,
                      CASE WHEN doc_id % 3 = 0 THEN ' visto l''art. 12 della legge 241 del 1990' ELSE '' END,
                      CASE WHEN doc_id % 5 = 0 THEN ' e il decreto legislativo 33/2013 e il d.l. 18' ELSE '' END,
                      '. ', text) AS testo
        FROM documents""",
    "minutes": """
        SELECT doc_id, concat('L''emendamento ', doc_id % 20 + 1, '.', doc_id % 5 + 1, ' è ',
                      CASE doc_id % 3 WHEN 0 THEN 'approvato' WHEN 1 THEN 'respinto' ELSE 'ritirato' END, '. ', text,
                      CASE WHEN doc_id % 4 = 0 THEN concat(' L''emendamento ', doc_id % 7 + 1, '.1 risulta Respinto.')
                           ELSE '' END) AS resoconto
        FROM documents""",
    "initiatives": """
        SELECT CAST(l_orderkey AS STRING) AS id_fase, CAST(l_orderkey % 7 + 13 AS INTEGER) AS legislatura,
               concat('iniz/', l_linenumber, '-', l_partkey) AS uri_iniziativa,
               CASE WHEN l_linenumber = 1 THEN '1' END AS primo_firmatario,
               CASE WHEN l_suppkey % 4 <> 0 THEN concat('senatore/', l_suppkey) END AS uri_senatore,
               concat('P', l_suppkey) AS nome_senatore, l_returnflag AS tipo_iniziativa,
               CAST(l_shipdate AS DATE) AS data_firma, CAST(NULL AS DATE) AS data_ritiro_firma
        FROM lineitem""",
    "people": """
        SELECT concat('senatore/', s_suppkey) AS senatore,
               CASE WHEN s_suppkey % 3 = 0 THEN concat('Sen. ', s_name) END AS label,
               CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS nome,
               concat('N', s_nationkey) AS cognome, CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS genere,
               '1960-01-01' AS dataNascita
        FROM supplier""",
    "joined": """
        SELECT concat('senatore/', user_id) AS senatore, concat('gruppo/', event_id % 30) AS gruppo,
               CASE WHEN event_id % 30 = 27 THEN 'Etichetta' END AS gruppoLabel,
               CAST(CAST(ts AS DATE) AS STRING) AS inizio,
               CASE WHEN event_id % 5 = 0 THEN NULL
                    ELSE CAST(CAST(ts AS DATE) + CAST(event_id % 11 AS INTEGER) AS STRING) END AS fine
        FROM events WHERE event_type = 'signup'""",
    "group_titles": """
        SELECT concat('gruppo/', n_nationkey) AS gruppo, concat(n_name, ' prima') AS titolo,
               concat('S', n_nationkey) AS titoloBreve, '2024-01-15' AS fine, 1 AS pos FROM nation
        UNION ALL
        SELECT concat('gruppo/', n_nationkey), concat(n_name, ' poi'), concat('S', n_nationkey),
               CASE WHEN n_nationkey % 2 = 0 THEN '2024-02-01' END, 2 FROM nation""",
    "proposals": """
        SELECT event_id AS em_id, user_id AS atto, CAST(ts AS DATE) AS data,
               concat(event_id % 4 + 1, '.', event_id % 7) AS number, user_id AS p1, user_id + 1 AS p2,
               concat('Sostituire <b> & ', props) AS testo
        FROM events WHERE event_type = 'view'""",
    "chamber_acts": """
        SELECT concat('http://atto/', o_orderkey) AS atto, CASE WHEN o_orderkey % 10 = 0 THEN concat(o_orderkey, '-B')
                    ELSE CAST(o_orderkey AS STRING) END AS id,
               CAST(year(o_orderdate) AS INTEGER) AS legislatura, o_orderstatus AS titolo,
               concat(year(o_orderdate), '0105') AS dc_date, 'Progetto di legge' AS tipo,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Parlamentare' END AS iniziativa,
               concat('http://scheda/', o_orderkey) AS url_scheda_camera
        FROM orders""",
    "chamber_lines": """
        SELECT concat('http://atto/', l_orderkey) AS atto, l_linenumber, l_returnflag, l_linestatus,
               concat('dep/', l_suppkey) AS dep, l_partkey, CAST(l_shipdate AS DATE) AS giorno,
               CAST(l_orderkey % 7 + 13 AS INTEGER) AS legislatura
        FROM lineitem""",
    "triples": """
        SELECT concat('fornitore/', s_suppkey) AS s, 'type' AS p, 'Fornitore' AS o, 'iri' AS o_kind, CAST(NULL AS STRING) AS o_datatype FROM supplier
        UNION ALL SELECT concat('fornitore/', s_suppkey), 'nome', s_name, 'literal', NULL FROM supplier
        UNION ALL SELECT concat('fornitore/', s_suppkey), 'nazione', concat('nazione/', s_nationkey), 'iri', NULL FROM supplier
        UNION ALL SELECT concat('fornitore/', s_suppkey), 'saldo', concat('_:f', s_suppkey), 'bnode', NULL FROM supplier
        UNION ALL SELECT concat('fornitore/', s_suppkey), 'saldo', concat('_:g', s_suppkey), 'bnode', NULL FROM supplier WHERE s_suppkey % 2 = 0
        UNION ALL SELECT concat('_:f', s_suppkey), 'intero', CAST(s_suppkey % 100 AS STRING), 'literal', 'xsd:integer' FROM supplier
        UNION ALL SELECT concat('_:g', s_suppkey), 'intero', CAST(s_suppkey % 100 AS STRING), 'literal', 'xsd:integer' FROM supplier WHERE s_suppkey % 2 = 0
        UNION ALL SELECT concat('cliente/', c_custkey), 'type', 'Cliente', 'iri', NULL FROM customer
        UNION ALL SELECT concat('cliente/', c_custkey), 'nome', c_name, 'literal', NULL FROM customer WHERE c_custkey % 7 <> 0
        UNION ALL SELECT concat('cliente/', c_custkey), 'segmento', c_mktsegment, 'literal', 'xsd:string' FROM customer
        UNION ALL SELECT concat('cliente/', c_custkey), 'segmento', 'ALTRO', 'literal', 'xsd:string' FROM customer WHERE c_custkey % 5 = 0
        UNION ALL SELECT concat('cliente/', c_custkey), 'nazione', concat('nazione/', c_nationkey), 'iri', NULL FROM customer
        UNION ALL SELECT concat('cliente/', c_custkey), 'nazione', concat('nazione/', c_nationkey), 'iri', NULL FROM customer
        UNION ALL SELECT concat('nazione/', n_nationkey), 'type', 'Nazione', 'iri', NULL FROM nation
        UNION ALL SELECT concat('nazione/', n_nationkey), 'nome', n_name, 'literal', NULL FROM nation
        UNION ALL SELECT concat('nazione/', n_nationkey), 'regione', concat('regione/', n_regionkey), 'iri', NULL FROM nation
        UNION ALL SELECT concat('regione/', r_regionkey), 'type', 'Regione', 'iri', NULL FROM region
        UNION ALL SELECT concat('regione/', r_regionkey), 'nome', r_name, 'literal', NULL FROM region""",
}

_TABLES = re.compile(r"\bFROM (orders|lineitem|events|nation|conversations|documents|supplier)\b")


def _triples(t) -> DataFrame:
    """The triple role with one scan of each table."""
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, *cells) -> DataFrame:
        named = [
            F.when(cond, F.struct(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"),
                                  F.lit(k).alias("o_kind"), d.alias("o_datatype")))
            for s, p, o, k, d, cond in cells
        ]
        return df.select(F.inline(F.array_compact(F.array(*named))))

    def uri(kind: str, key: str):
        return F.concat(F.lit(f"{kind}/"), F.col(key))

    def node(mark: str):
        return F.concat(F.lit(f"_:{mark}"), F.col("s_suppkey"))

    yes, whole = F.lit(True), F.lit("xsd:integer")
    sup, cust = uri("fornitore", "s_suppkey"), uri("cliente", "c_custkey")
    nat, reg = uri("nazione", "n_nationkey"), uri("regione", "r_regionkey")
    even, ref = F.col("s_suppkey") % 2 == 0, uri("nazione", "c_nationkey")
    rest = F.col("s_suppkey") % 100
    text = F.lit("xsd:string")
    parts = [
        rows(
            t("supplier"),
            (sup, "type", F.lit("Fornitore"), "iri", none, yes),
            (sup, "nome", F.col("s_name"), "literal", none, yes),
            (sup, "nazione", uri("nazione", "s_nationkey"), "iri", none, yes),
            (sup, "saldo", node("f"), "bnode", none, yes),
            (sup, "saldo", node("g"), "bnode", none, even),
            (node("f"), "intero", rest, "literal", whole, yes),
            (node("g"), "intero", rest, "literal", whole, even),
        ),
        rows(
            t("customer"),
            (cust, "type", F.lit("Cliente"), "iri", none, yes),
            (cust, "nome", F.col("c_name"), "literal", none, F.col("c_custkey") % 7 != 0),
            (cust, "segmento", F.col("c_mktsegment"), "literal", text, yes),
            (cust, "segmento", F.lit("ALTRO"), "literal", text, F.col("c_custkey") % 5 == 0),
            (cust, "nazione", ref, "iri", none, yes),
            (cust, "nazione", ref, "iri", none, yes),
        ),
        rows(
            t("nation"),
            (nat, "type", F.lit("Nazione"), "iri", none, yes),
            (nat, "nome", F.col("n_name"), "literal", none, yes),
            (nat, "regione", uri("regione", "n_regionkey"), "iri", none, yes),
        ),
        rows(
            t("region"),
            (reg, "type", F.lit("Regione"), "iri", none, yes),
            (reg, "nome", F.col("r_name"), "literal", none, yes),
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _governments(t) -> DataFrame:
    """Cabinets with their majority as an array of at most 30 groups."""
    members = t.role("majority").groupBy("legislatura", "q").agg(F.array_sort(F.collect_set("sigla")).alias("maggioranza"))
    return t.role("cabinets").join(members, ["legislatura", "q"], "left").drop("q")


_BUILT = {"triples": _triples, "governments": _governments}


def spark_role(t, name: str) -> DataFrame:
    if name in _BUILT:
        return _BUILT[name](t)
    text = ROLE_SQL[name]
    used = sorted(set(_TABLES.findall(text)))
    return t.sql(_TABLES.sub(r"FROM {\1}", text), **{table: t.documents if table == "documents" else t(table) for table in used})
