"""Column functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bodies, dates, texts, uris
from ..operators.graph import datatypes
from .base import Tables, query

BROKEN = "CittÃ  perchÃ¨  Â«"
BROKEN_END = "Â» â\u0080¦ Ã‰ fine"


@query(
    "f1_fix_encoding",
    f"""SELECT c_custkey, trim(regexp_replace(
          replace(replace(replace(replace(replace(replace(
            concat('{BROKEN}', c_mktsegment, '{BROKEN_END}'),
            'Ã ', 'à'), 'Ã¨', 'è'), 'Ã‰', 'É'), 'â\u0080¦', '...'), 'Â«', '«'), 'Â»', '»'),
          '[\\s\\x{{00A0}}]+', ' ', 'g')) AS testo FROM customer""",
)
def f1(t: Tables):
    raw = F.concat(F.lit(BROKEN), F.col("c_mktsegment"), F.lit(BROKEN_END))
    return t("customer").select("c_custkey", texts.fix_encoding(raw).alias("testo"))


@query(
    "f2_collapse_space",
    "SELECT doc_id, trim(regexp_replace(concat(chr(160), text, chr(8239)), '[\\s\\x{00A0}\\x{202F}]+', ' ', 'g')) AS testo FROM documents",
)
def f2(t: Tables):
    raw = F.concat(F.lit(" "), F.col("text"), F.lit(" "))
    return t.documents.select("doc_id", texts.collapse_space(raw).alias("testo"))


@query(
    "f3_article_number",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat(p_size, '') WHEN 1 THEN concat(p_size, '-bis')
                         WHEN 2 THEN concat('Allegato', p_size) ELSE concat(p_size, '.Art.') END AS num_clean FROM part""",
)
def f3(t: Tables):
    size, k = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    raw = (
        F.when(k == 0, F.concat(F.lit("Art. "), size, F.lit(".")))
        .when(k == 1, F.concat(F.lit("Art."), size, F.lit(" -bis.")))
        .when(k == 2, F.concat(F.lit("Allegato "), size))
        .otherwise(F.concat(F.lit("Art "), size, F.lit(".Art..")))
    )
    return t("part").select("p_partkey", texts.article_number(raw).alias("num_clean"))


@query(
    "f4_target_article",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE CAST(p_size AS STRING) END AS articolo FROM part""",
)
def f4(t: Tables):
    size, k = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    number = F.when(k == 0, F.concat(size, F.lit(".1"))).when(k == 1, F.lit("")).when(k == 3, F.lit(""))
    target = F.when(k != 3, F.concat(F.lit("Emendamento n. "), size, F.lit(".12.3"))).otherwise(F.lit(""))
    return t("part").select("p_partkey", texts.target_article(number, target).alias("articolo"))


@query("f5_word_count", "SELECT doc_id, CAST(len(string_split_regex(concat(' ', text), '\\s+')) AS BIGINT) AS n FROM documents")
def f5(t: Tables):
    return t.documents.select("doc_id", texts.word_count(F.concat(F.lit(" "), F.col("text"))).cast("bigint").alias("n"))


@query("f6_char_count", "SELECT doc_id, length(text) AS n FROM documents")
def f6(t: Tables):
    return t.documents.select("doc_id", texts.char_count("text").alias("n"))


@query("f7_uri_tail", "SELECT page_id, regexp_extract(rtrim(url, '/'), '([^/]*)$', 1) AS coda FROM pages")
def f7(t: Tables):
    return t("pages").select("page_id", uris.uri_tail("url").alias("coda"))


@query(
    "f8_parse_date",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data FROM orders""",
)
def f8(t: Tables):
    day, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    raw = (
        F.when(k == 0, F.date_format(day, "yyyyMMdd"))
        .when(k == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(k == 2, F.concat(F.date_format(day, "yyyyMMdd"), F.lit("T10")))
        .when(k == 3, F.date_format(day, "yyyyMM"))
        .otherwise(F.concat(F.date_format(day, "yyyy"), F.lit("9919")))
    )
    return t("orders").select("o_orderkey", dates.parse_yyyymmdd(raw).alias("data"))


@query(
    "f9_full_name",
    """SELECT c_custkey, nullif(concat_ws(' ', CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END,
                                          CASE WHEN c_custkey % 3 = 0 THEN c_name END), '') AS nome FROM customer""",
)
def f9(t: Tables):
    first = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))
    last = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name"))
    return t("customer").select("c_custkey", texts.full_name(first, last).alias("nome"))


@query(
    "f10_split_label",
    """SELECT p_partkey, string_split(etichetta, ' ')[1] AS nome,
              CASE WHEN contains(etichetta, ' ') THEN substr(etichetta, strpos(etichetta, ' ') + 1) END AS cognome
       FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE concat(p_name, ' ', p_type) END AS etichetta FROM part)""",
)
def f10(t: Tables):
    label = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat_ws(" ", "p_name", "p_type"))
    df = t("part").select("p_partkey", label.alias("l"))
    return df.select("p_partkey", texts.first_word("l").alias("nome"), texts.after_first_word("l").alias("cognome"))


@query("f11_gender_of_role", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS genere FROM supplier")
def f11(t: Tables):
    role = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("La Senatrice "), F.col("s_name"))).when(
        F.col("s_suppkey") % 3 == 0, F.concat(F.lit("Il Senatore "), F.col("s_name"))
    )
    return t("supplier").select("s_suppkey", texts.gender_of_role(role).alias("genere"))


@query("f12_drop_repeated_number", "SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS testo FROM documents")
def f12(t: Tables):
    num = F.concat((F.col("doc_id") % 30).cast("string"), F.lit("."))
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(num, F.lit(" "), F.col("text"))).otherwise(texts.strip_space("text"))
    return t.documents.select("doc_id", texts.drop_repeated_number(raw, num).alias("testo"))


@query("f13_join_paragraphs", "SELECT doc_id, text AS testo FROM documents")
def f13(t: Tables):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text")))
    return t.documents.select("doc_id", texts.join_texts(lines, "text").alias("testo"))


@query(
    "f14_classify_url",
    """SELECT page_id, CASE page_id % 5 WHEN 0 THEN '/_dati/legN/lavori/stampati/pdf/*.pdf' WHEN 1 THEN '/_dati/legN/lavori/...  (non-PDF)'
                       WHEN 2 THEN 'camera.it/*.pdf (altro)' WHEN 3 THEN 'camera.it/* (non-PDF)' ELSE 'altra origine' END AS tipo FROM pages""",
)
def f14(t: Tables):
    k = F.col("page_id") % 5
    url = (
        F.when(k == 0, F.concat(F.lit("http://x/_dati/leg17/lavori/stampati/pdf/"), F.col("page_id"), F.lit(".pdf")))
        .when(k == 1, F.lit("http://x/_dati/leg17/lavori/atto.htm"))
        .when(k == 2, F.concat(F.lit("http://www.camera.it/"), F.col("page_id"), F.lit(".PDF")))
        .when(k == 3, F.lit("http://www.camera.it/scheda"))
        .otherwise(F.col("url"))
    )
    return t("pages").select("page_id", uris.classify_url(url).alias("tipo"))


@query(
    "f15_url_extension",
    "SELECT page_id, lower(string_split(string_split(url, '.')[-1], '?')[1]) AS ext FROM pages",
)
def f15(t: Tables):
    return t("pages").select("page_id", uris.url_extension("url").alias("ext"))


@query("f16_digits_only", "SELECT p_partkey, p_partkey % 5 <> 0 AS cifre FROM part")
def f16(t: Tables):
    size = F.col("p_size").cast("string")
    code = F.when(F.col("p_partkey") % 5 == 0, F.concat(size, F.lit("-bis"))).otherwise(size)
    return t("part").select("p_partkey", texts.is_digits(code).alias("cifre"))


@query(
    "f17_days_floored",
    """SELECT member_id, greatest(0, date_diff('day', inizio, coalesce(fine, DATE '2024-01-20'))) AS giorni FROM memberships""",
    "memberships",
)
def f17(t: Tables):
    return t.role("memberships").select("member_id", dates.days_between("inizio", "fine", "2024-01-20").alias("giorni"))


@query("f18_strip_hash", "SELECT s_suppkey, s_name AS rif FROM supplier")
def f18(t: Tables):
    return t("supplier").select("s_suppkey", uris.strip_hash(F.concat(F.lit("##"), F.col("s_name"))).alias("rif"))


@query(
    "f19_body_class",
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'PDF' WHEN 1 THEN 'XML' WHEN 2 THEN 'AKN' WHEN 3 THEN 'sconosciuto'
              WHEN 4 THEN 'errore HTTP 404'
              ELSE CASE WHEN regexp_matches(lower(html), 'emendament|proposta|articolo|comma|disegno di legge|legislatur|testo')
                        THEN 'HTML con contenuto' ELSE 'HTML vuoto/errore' END END AS tipo,
              trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS titolo,
              trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS testo
       FROM pages""",
)
def f19(t: Tables):
    k = F.col("page_id") % 6
    body = (
        F.when(k == 0, F.lit("%PDF-1.4")).when(k == 1, F.lit("﻿<?xml version='1.0'?><a/>"))
        .when(k == 2, F.lit("<?xml version='1.0'?><akomaNtoso/>")).when(k == 3, F.lit("x")).otherwise(F.col("html"))
    )
    status = F.when(k == 4, 404).otherwise(200)
    return t("pages").select(
        "page_id",
        bodies.classify_body(F.lit("text/html"), body, status).alias("tipo"),
        bodies.page_title("html").alias("titolo"),
        bodies.strip_tags("html").alias("testo"),
    )


@query("f20_shorten_namespaces", "SELECT s_suppkey, concat('ocd:', s_name, ' rdfs:label') AS breve FROM supplier")
def f20(t: Tables):
    long = F.concat(F.lit("http://dati.camera.it/ocd/"), F.col("s_name"), F.lit(" http://www.w3.org/2000/01/rdf-schema#label"))
    return t("supplier").select("s_suppkey", texts.shorten_namespaces(long).alias("breve"))


@query("f21_decode_by_mark", "SELECT doc_id, text AS testo FROM documents")
def f21(t: Tables):
    k = F.col("doc_id") % 3
    raw = (
        F.when(k == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8")))
        .when(k == 1, F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE")))
        .otherwise(F.encode("text", "UTF-8"))
    )
    return t.documents.select("doc_id", bodies.decode_bytes(raw).alias("testo"))


@query(
    "f22_urn_parts",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN CAST(13 + o_orderkey % 7 AS INTEGER) END AS legislatura,
              CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS STRING) WHEN 1 THEN concat(o_orderkey, '-B')
                                  WHEN 2 THEN CAST(o_orderkey AS STRING) END AS numero,
              o_orderkey % 4 = 2 AS approvato FROM orders""",
)
def f22(t: Tables):
    k, key, leg = F.col("o_orderkey") % 4, F.col("o_orderkey").cast("string"), (F.col("o_orderkey") % 7 + 13).cast("string")
    head, mid = F.lit("urn:nir:senato.repubblica:disegno.legge"), F.lit(".legislatura;")
    urn = (
        F.when(k == 0, F.concat(head, F.lit(":"), leg, mid, key))
        .when(k == 1, F.concat(head, F.lit(":"), leg, mid, key, F.lit("-B")))
        .when(k == 2, F.concat(head, F.lit(";approvato:"), leg, mid, key))
        .otherwise(F.concat(F.lit("urn:lex:it:"), key))
    )
    df = t("orders").select("o_orderkey", urn.alias("urn"))
    return df.select(
        "o_orderkey",
        uris.urn_legislature("urn").alias("legislatura"),
        uris.urn_number("urn").alias("numero"),
        uris.urn_is_approved("urn").alias("approvato"),
    )


@query(
    "f23_government_bill",
    """SELECT id_fase, coalesce(contains(natura, 'DL'), false) OR descr_iniziativa = 'Governativa' AS letterale,
              coalesce(regexp_matches(natura, '(^|[^D])DL'), false) OR descr_iniziativa = 'Governativa' AS corretto FROM phases""",
    "phases",
)
def f23(t: Tables):
    return t.role("phases").select(
        "id_fase",
        texts.is_government_bill("natura", "descr_iniziativa").alias("letterale"),
        texts.is_government_bill("natura", "descr_iniziativa", literal=False).alias("corretto"),
    )


@query(
    "f24_legislature_of_uri",
    "SELECT DISTINCT legislatura, concat('http://dati.camera.it/ocd/legislatura.rdf/repubblica_', legislatura) AS uri, legislatura AS letta FROM acts",
    "acts",
)
def f24(t: Tables):
    legs = t.role("acts").select("legislatura").distinct().withColumn("uri", uris.legislature_uri("legislatura"))
    return legs.withColumn("letta", uris.legislature_of("uri"))


@query("f25_keyword_flag", "SELECT p_partkey, contains(lower(p_name), 'red') OR contains(lower(p_name), 'hot') AS segno FROM part")
def f25(t: Tables):
    return t("part").select("p_partkey", texts.contains_any("p_name", ["red", "hot"]).alias("segno"))


@query("f26_literal_datatypes", "SELECT p, o_datatype, count(*) AS n FROM triples WHERE o_kind = 'literal' GROUP BY p, o_datatype", "triples")
def f26(t: Tables):
    return datatypes(t.role("triples"))


@query("f27_default_text", "SELECT id_fase, coalesce(ramo_origine, 'Unknown') AS ramo FROM phases", "phases")
def f27(t: Tables):
    return t.role("phases").select("id_fase", texts.or_default("ramo_origine", "Unknown").alias("ramo"))
