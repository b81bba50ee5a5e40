"""Act files, nested documents and their tables. Files are derived from the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bodies
from ..operators import flatten
from ..operators.documents import parse_amendments, parse_bills
from ..plans.acts import act_tables, build_documents
from ..plans.persons import registry_persons
from ..sources import add_path_parts
from .base import Tables, query
from .xml import amendment_files, bill_files

TRIMMED = "list_transform(string_split(text, chr(10)), lambda x: trim(x))"


def _bills(t):
    return bill_files(t.documents).select("path", "content")


def _amendments(t):
    return amendment_files(t.role("proposals")).select("path", "content")


def _located(df):
    return add_path_parts(df).withColumn("versione", F.col("kind"))


@query(
    "x1_parse_bills",
    f"""SELECT doc_id AS number, '2024-01-15' AS date, 'ddl' AS type, concat('Il titolo vero ', doc_id) AS titolo, 'Art. 1.' AS num,
              len(string_split(text, chr(10))) AS n_commi, CAST(list_sum(list_transform({TRIMMED}, lambda x: length(x))) AS BIGINT) AS n_caratteri,
              'Rossi F true;Bianchi M false' AS firmatari FROM documents""",
)
def x1(t: Tables):
    article = F.col("articles")[0]
    signers = F.transform("proponents", lambda p: F.concat_ws(" ", p["name"], p["genere"], p["primo_firmatario"].cast("string")))
    return parse_bills(_bills(t)).select(
        F.col("number").cast("bigint").alias("number"),
        "date",
        "type",
        article["heading"].alias("titolo"),
        article["num"].alias("num"),
        F.size(article["paragraphs"]).alias("n_commi"),
        F.aggregate(article["paragraphs"], F.lit(0).cast("bigint"), lambda a, p: a + F.char_length(p["text"])).alias("n_caratteri"),
        F.array_join(signers, ";").alias("firmatari"),
    )


@query(
    "x2_parse_amendments",
    """SELECT em_id AS id, CAST(data AS STRING) AS date, number, 'em' AS name, '/bill/1' AS target_ddl, 'Emendamento n. 3.1' AS target_info,
              concat('Nome ', p1, '|/persone/', p1, ';Nome ', p2, '|/persone/', p2) AS proponenti, testo FROM proposals""",
    "proposals",
)
def x2(t: Tables):
    people = F.transform("proponents", lambda p: F.concat_ws("|", p["name"], p["href"]))
    return parse_amendments(_amendments(t)).select(
        F.col("id").cast("bigint").alias("id"), "date", "number", "name", "target_ddl", "target_info",
        F.array_join(people, ";").alias("proponenti"), F.array_join("content", "|").alias("testo"),
    )


PERSONS = """SELECT substr(senatore, 10) AS id, coalesce(label, CASE WHEN nome IS NOT NULL THEN concat(nome, ' ', cognome) END) AS full_name,
              nome AS first_name, cognome AS last_name, genere AS gender FROM people"""
NAMES = """SELECT gruppo, titolo AS nome, titoloBreve AS sigla FROM (SELECT *, row_number() OVER (PARTITION BY gruppo
              ORDER BY fine IS NULL DESC, CASE WHEN fine IS NULL THEN pos END, pos DESC) AS rn FROM group_titles) WHERE rn = 1"""
SPANS = f"""SELECT DISTINCT substr(j.senatore, 10) AS id, j.gruppo AS uri, coalesce(n.nome, j.gruppoLabel, substr(j.gruppo, 8)) AS nome, j.inizio, j.fine
              FROM joined j LEFT JOIN ({NAMES}) n ON j.gruppo = n.gruppo"""


def _persons(t):
    return registry_persons(t.role("people"), t.role("joined"), t.role("group_titles"))


@query(
    "x3_registry_persons",
    f"""SELECT p.*, coalesce(s.n, 0) AS n_gruppi FROM ({PERSONS}) p LEFT JOIN (SELECT id, count(*) AS n FROM ({SPANS}) GROUP BY id) s ON p.id = s.id""",
    "people joined group_titles",
)
def x3(t: Tables):
    parts = _persons(t).groupBy("id", "full_name", "first_name", "last_name", "gender")
    return parts.agg(F.sum(F.size("gruppi")).alias("n_gruppi"))


FLAT = f"""SELECT p.id AS senatore_id, p.full_name, p.first_name, p.last_name, p.gender, '1960-01-01' AS birth_date,
              s.nome AS gruppo_nome, s.inizio AS gruppo_inizio, s.fine AS gruppo_fine, s.uri AS gruppo_uri
       FROM ({PERSONS}) p LEFT JOIN ({SPANS}) s ON p.id = s.id"""


@query("x4_flatten_persons", FLAT, "people joined group_titles")
def x4(t: Tables):
    return flatten.flatten_persons(_persons(t))


@query("d9_registry", FLAT, "people joined group_titles")
def d9(t: Tables):
    return flatten.flatten_persons(_persons(t))


ARTICLES = """SELECT concat('Atto', doc_id) AS atto_id, 'art1' AS articolo_id, 'Art. 1.' AS numero_articolo, concat('Il titolo vero ', doc_id) AS titolo,
              'ddlpres' AS versione, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS testo_integrale FROM documents"""


def _flat(t, name):
    return flatten.flatten_act(build_documents(_bills(t), _amendments(t), _persons(t), per_part=50))[name]


@query("x5_flatten_act", ARTICLES)
def x5(t: Tables):
    return _flat(t, "t_articoli")


ACTS = """SELECT concat('Atto', doc_id) AS atto_id, '19' AS legislatura FROM documents UNION SELECT concat('Atto', atto), '19' FROM proposals"""


@query("x5_acts", ACTS, "proposals")
def x5_acts(t: Tables):
    return _flat(t, "t_atti")


@query("d10_acts", ACTS, "proposals")
def d10_acts(t: Tables):
    return act_tables(_bills(t), _amendments(t), _persons(t), ["t_atti"])["t_atti"]


SIGNERS = """SELECT concat('Atto', doc_id) AS atto_id, 'Rossi' AS nome, 'F' AS genere, true AS primo_firmatario FROM documents
       UNION ALL SELECT concat('Atto', doc_id), 'Bianchi', 'M', false FROM documents"""


@query("x5_signers", SIGNERS)
def x5_signers(t: Tables):
    return _flat(t, "t_firmatari_atto")


@query("d10_act_signers", SIGNERS)
def d10_signers(t: Tables):
    return act_tables(_bills(t), _amendments(t), _persons(t), ["t_firmatari_atto"])["t_firmatari_atto"]


@query("d10_act_articles", ARTICLES)
def d10_articles(t: Tables):
    return act_tables(_bills(t), _amendments(t), _persons(t), ["t_articoli"])["t_articoli"]


@query(
    "x6_one_per_version",
    """SELECT concat('Atto', doc_id % 50) AS atto_id, 'ddlpres' AS versione, arg_min(doc_id, concat('data/Leg19/Atto', doc_id % 50, '/ddlpres/', doc_id, '.akn.xml')) AS number
       FROM documents GROUP BY 1""",
)
def x6(t: Tables):
    path = F.concat(F.lit("data/Leg19/Atto"), F.col("doc_id") % 50, F.lit("/ddlpres/"), F.col("doc_id"), F.lit(".akn.xml"))
    files = bill_files(t.documents).withColumn("path", path)
    kept = flatten.one_per_version(_located(parse_bills(files)))
    return kept.select("atto_id", "versione", F.col("number").cast("bigint").alias("number"))


@query("x7_amendments_with_metadata", "SELECT em_id, number FROM proposals WHERE em_id % 7 NOT IN (0, 1)", "proposals")
def x7(t: Tables):
    files = amendment_files(t.role("proposals"))
    bare = F.when(F.col("em_id") % 7 == 0, F.encode(F.lit("<akomaNtoso/>"), "UTF-8")).when(
        F.col("em_id") % 7 == 1, F.encode(F.lit("<akoma"), "UTF-8")
    )
    parsed = parse_amendments(files.withColumn("content", F.coalesce(bare, "content")))
    return flatten.with_metadata(parsed).select(F.col("id").cast("bigint").alias("em_id"), "number")


@query(
    "x8_presented_signers",
    """SELECT concat('Atto', doc_id) AS atto_id, 'Rossi' AS nome, 'F' AS genere, true AS primo_firmatario FROM documents WHERE doc_id % 2 = 0
       UNION ALL SELECT concat('Atto', doc_id), 'Bianchi', 'M', false FROM documents WHERE doc_id % 2 = 0""",
)
def x8(t: Tables):
    bills = _located(parse_bills(_bills(t)))
    later = F.when(F.col("number").cast("bigint") % 2 != 0, "ddlmess").otherwise(F.col("versione"))
    return flatten.bill_signers(bills.withColumn("versione", later))


@query(
    "x9_anchored_block",
    """SELECT page_id, trim(regexp_replace(regexp_replace(concat('t ', url, ' & altro ', html), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS testo FROM pages""",
)
def x9(t: Tables):
    html = F.concat(
        F.lit('<a name="x.1">t</a> <b>'), F.col("url"), F.lit("</b> & altro "), F.col("html"), F.lit('<a class="k" id="x.2">u</a>')
    )
    return t("pages").select("page_id", bodies.strip_tags(bodies.anchored_block(html, "x.1")).alias("testo"))


@query(
    "x10_explode_votes",
    """SELECT o_orderkey AS id_votazione, 'favorevole' AS voto, CAST(o_custkey AS STRING) AS id_senatore FROM orders
       UNION ALL SELECT o_orderkey, 'favorevole', CAST(o_custkey + 1 AS STRING) FROM orders
       UNION ALL SELECT o_orderkey, 'contrario', CAST(o_custkey + 2 AS STRING) FROM orders WHERE o_orderkey % 2 = 0""",
)
def x10(t: Tables):
    return _votes(t).select("id_votazione", "voto", "id_senatore")


def _votes(t):
    def person(n):
        return F.concat(F.lit("http://x/senatore/"), F.col("o_custkey") + n)

    votes = t("orders").select(
        F.col("o_orderkey").alias("id_votazione"),
        F.col("o_orderdate").cast("date").alias("data"),
        F.array(person(0), person(1)).alias("si"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(person(2))).otherwise(F.array().cast("array<string>")).alias("no"),
        F.lit(None).cast("array<string>").alias("ast"),
    )
    return flatten.explode_votes(votes, "id_votazione", {"favorevole": "si", "contrario": "no", "astenuto": "ast"})


PROPONENTS = f"""WITH listed AS (
         SELECT em_id, data, CAST(p1 AS STRING) AS pid FROM proposals UNION ALL SELECT em_id, data, CAST(p2 AS STRING) FROM proposals),
       spans AS ({SPANS}), persons AS ({PERSONS}),
       hits AS (SELECT l.em_id, l.pid, s.nome, row_number() OVER (PARTITION BY l.em_id, l.pid ORDER BY s.inizio, s.uri, s.fine NULLS FIRST) AS rn
         FROM listed l JOIN spans s ON l.pid = s.id JOIN persons p ON p.id = s.id
         WHERE CAST(s.inizio AS DATE) <= l.data AND (s.fine IS NULL OR CAST(s.fine AS DATE) >= l.data))
       SELECT CAST(l.em_id AS STRING) AS emendamento_id, l.pid AS proponente_id,
              CASE WHEN p.id IS NULL THEN concat('Nome ', l.pid) ELSE p.full_name END AS proponente_nome,
              CASE WHEN p.id IS NULL THEN NULL WHEN h.em_id IS NULL THEN 'Misto / Sconosciuto' ELSE h.nome END AS proponente_gruppo,
              p.gender AS proponente_genere
       FROM listed l LEFT JOIN persons p ON p.id = l.pid LEFT JOIN hits h ON h.em_id = l.em_id AND h.pid = l.pid AND h.rn = 1"""


@query("x5_proponents", PROPONENTS, "proposals people joined group_titles")
def x5_proponents(t: Tables):
    return _flat(t, "t_proponenti")


@query("d10_act_proponents", PROPONENTS, "proposals people joined group_titles")
def d10(t: Tables):
    return act_tables(_bills(t), _amendments(t), _persons(t), ["t_proponenti"])["t_proponenti"]


AMENDMENTS = """SELECT concat('Atto', atto) AS atto_id, CAST(em_id AS STRING) AS emendamento_id, number AS numero_emendamento,
              string_split(number, '.')[1] AS articolo_target, data, 'Emendamento n. 3.1' AS target_info, testo AS testo_emendamento FROM proposals"""


@query("x5_amendments", AMENDMENTS, "proposals")
def x5_amendments(t: Tables):
    return _flat(t, "t_emendamenti")


@query("d10_act_amendments", AMENDMENTS, "proposals")
def d10_amendments(t: Tables):
    return act_tables(_bills(t), _amendments(t), _persons(t), ["t_emendamenti"])["t_emendamenti"]


@query(
    "d13_votes_with_dates",
    """SELECT o_orderkey AS id_votazione, CAST(o_orderdate AS DATE) AS data, CAST(year(o_orderdate) AS INTEGER) AS legislatura,
              count(*) AS presenti FROM (
         SELECT o_orderkey, o_orderdate FROM orders UNION ALL SELECT o_orderkey, o_orderdate FROM orders
         UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 2 = 0) GROUP BY 1, 2, 3""",
)
def d13(t: Tables):
    counted = _votes(t).groupBy("id_votazione", "data").agg(F.count("*").alias("presenti"))
    legs = t.role("acts").select(F.col("id_atto").alias("id_votazione"), "legislatura")
    return counted.join(legs, "id_votazione")
