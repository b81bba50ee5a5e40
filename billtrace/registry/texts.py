"""Text measures, distance and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import texts
from ..operators import measures, similarity
from .base import Tables, query
from .joins import FRAGMENTATION, GROWTH

COUNTS = r"""len(regexp_extract_all({c}, '\p{{L}}')) AS l, len(regexp_extract_all({c}, '[^\t\n\f\r ]+')) AS w,
              len(regexp_extract_all({c}, '[.!?]+')) AS r"""
SENTENCES = "CASE WHEN r > 0 THEN r WHEN w > 0 THEN 1 ELSE 0 END"
SCORE = "89 + (300.0 * s - 10.0 * l) / nullif(CAST(w AS DOUBLE), 0)"
BAND = "CASE WHEN g < 40 THEN 'incomprensibile' WHEN g < 60 THEN 'difficile' WHEN g <= 80 THEN 'normale' WHEN g > 80 THEN 'semplice' END"


def _measured(source: str, column: str, keep: str) -> str:
    return f"""(SELECT *, {SCORE} AS g FROM (SELECT *, {SENTENCES} AS s FROM (
        SELECT {keep}, length({column}) AS n_caratteri, {COUNTS.format(c=column)} FROM {source})))"""


@query("t1_text_counts", f"SELECT doc_id, n_caratteri, w AS n_parole, s AS n_frasi, l AS n_lettere FROM {_measured('documents', 'text', 'doc_id')}")
def t1(t: Tables):
    out = measures.text_metrics(t.documents, "text", ["doc_id"])
    return out.select("doc_id", "n_caratteri", "n_parole", "n_frasi", "n_lettere")


@query("t3_gulpease", f"SELECT doc_id, round(g, 4) AS gulpease FROM {_measured('documents', 'text', 'doc_id')}")
def t3(t: Tables):
    return measures.text_metrics(t.documents, "text", ["doc_id"]).select("doc_id", F.round("gulpease", 4).alias("gulpease"))


@query("t4_gulpease_band", f"SELECT {BAND} AS fascia, count(*) AS n FROM {_measured('documents', 'text', 'doc_id')} GROUP BY 1")
def t4(t: Tables):
    return measures.text_metrics(t.documents, "text", ["doc_id"]).groupBy("fascia").agg(F.count("*").alias("n"))


def _articles(t):
    return t("conversations").select("conv_id", "text", F.split("text", "\n").alias("commi"))


@query(
    "t2_articles_paragraphs",
    "SELECT conv_id, count(*) AS n_articoli, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_commi FROM conversations GROUP BY conv_id",
)
def t2(t: Tables):
    return measures.article_sizes(_articles(t), "conv_id", "text", "commi").select("conv_id", "n_articoli", "n_commi")


@query(
    "t6_mean_article_length",
    "SELECT conv_id, round(avg(length(text)), 4) AS lunghezza_media_articolo FROM conversations GROUP BY conv_id",
)
def t6(t: Tables):
    out = measures.article_sizes(_articles(t), "conv_id", "text", "commi")
    return out.select("conv_id", F.round("lunghezza_media_articolo", 4).alias("lunghezza_media_articolo"))


REFERENCES = r"""len(regexp_extract_all(lower({c}), 'legge \d+ del \d{{4}}')) + len(regexp_extract_all(lower({c}), 'decreto legislativo \d+/\d{{4}}'))
              + len(regexp_extract_all(lower({c}), 'art\. \d+')) + len(regexp_extract_all(lower({c}), 'd\.l\. \d+'))"""


@query("t5_norm_references", f"SELECT doc_id, {REFERENCES.format(c='testo')} AS n FROM texts", "texts")
def t5(t: Tables):
    return t.role("texts").select("doc_id", texts.norm_references("testo").alias("n"))


@query(
    "t8_growth_by_act",
    f"""SELECT g.*, f.num_emendamenti, f.num_gruppi_coinvolti FROM ({GROWTH}) g LEFT JOIN (
         {FRAGMENTATION.replace("SELECT a.articolo_target", "SELECT a.atto_id, a.articolo_target").replace("GROUP BY", "GROUP BY a.atto_id,")}) f
       ON g.num_clean = f.num_clean AND g.atto_id = f.atto_id""",
    "articles amendments proponents",
)
def t8(t: Tables):
    return measures.growth_vs_fragmentation(t.role("articles"), t.role("amendments"), t.role("proponents"), by_act=True)


@query(
    "t9_amendment_type",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'soppressione' WHEN 1 THEN 'modifica' WHEN 2 THEN 'aggiunta' ELSE 'modifica' END AS tipo FROM documents""",
)
def t9(t: Tables):
    opening = F.element_at(
        F.array(*[F.lit(s) for s in (" Sopprimere il comma. ", "Sostituire le parole: ", "Dopo il comma 1, inserire: ", "All'articolo 3, sostituire: ")]),
        (F.col("doc_id") % 4 + 1).cast("int"),
    )
    return t.documents.select("doc_id", texts.amendment_type(F.concat(opening, F.col("text"))).alias("tipo"))


RUNS = """list_distinct(list_transform(range(1, greatest(len({w}) - 2, 1) + 1), lambda i: array_to_string({w}[i:i+2], ' ')))"""


@query(
    "t10_text_distance",
    f"""SELECT conv_id, turn, round(CAST(len(list_intersect(x, y)) AS DOUBLE) / (len(x) + len(y) - len(list_intersect(x, y))), 6) AS similarita
       FROM (SELECT conv_id, turn, {RUNS.format(w='wa')} AS x, {RUNS.format(w='wb')} AS y FROM (
         SELECT a.conv_id, a.turn, string_split(trim(regexp_replace(lower(a.text), '\\s+', ' ', 'g')), ' ') AS wa,
                string_split(trim(regexp_replace(lower(concat(a.text, ' ', b.text)), '\\s+', ' ', 'g')), ' ') AS wb
         FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1))""",
)
def t10(t: Tables):
    c = t("conversations").select("conv_id", "turn", "text")
    later = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("dopo"))
    pairs = c.join(later, ["conv_id", "turn"]).withColumn(
        "dopo", F.concat(F.col("text"), F.lit(" "), F.col("dopo"))
    )
    out = similarity.text_distance(pairs, "text", "dopo")
    return out.select("conv_id", "turn", F.round("similarita", 6).alias("similarita"))


CLUSTERS = f"""WITH RECURSIVE s AS (SELECT doc_id, {RUNS.format(w='w')} AS x FROM (
         SELECT doc_id, string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL)),
       e AS (SELECT doc_id, len(x) AS n, unnest(x) AS g FROM s),
       i AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
         FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
       l AS (SELECT a, b FROM i WHERE c * 100 >= 80 * (na + nb - c)),
       r AS (SELECT a AS id, a AS m FROM l UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.id),
       k AS (SELECT id, min(m) AS cluster FROM r GROUP BY id)
       """


@query(
    "t10_similar_pairs",
    CLUSTERS + """SELECT k.cluster AS a, k.id AS b, round(coalesce(CAST(i.c AS DOUBLE) / (i.na + i.nb - i.c), 0), 6) AS similarita
       FROM k LEFT JOIN i ON i.a = k.cluster AND i.b = k.id WHERE k.id <> k.cluster""",
)
def t10_pairs(t: Tables):
    return similarity.similar_pairs(t.documents, "doc_id", "text").withColumn("similarita", F.round("similarita", 6))


@query("t11_clusters", CLUSTERS + "SELECT id, cluster FROM k")
def t11(t: Tables):
    return similarity.similar_clusters(t.documents, "doc_id", "text").select("id", "cluster")


@query(
    "t11_copy_clusters",
    """SELECT doc_id AS id, m AS cluster FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY f) AS m, count(*) OVER (PARTITION BY f) AS n
         FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS f FROM documents)) WHERE n > 1""",
)
def t11_copies(t: Tables):
    return similarity.clusters(similarity.exact_copies(t.documents, "doc_id", "text"))


@query(
    "t12_outcomes",
    r"""SELECT doc_id, regexp_extract(h, '(\d+\.\d+)', 1) AS numero_emendamento, lower(regexp_extract(h, '(\w+)$', 1)) AS esito FROM (
         SELECT doc_id, unnest(regexp_extract_all(resoconto, '(?i)l''emendamento \d+\.\d+ (?:è|risulta) (?:approvato|respinto|ritirato)')) AS h FROM minutes)""",
    "minutes",
)
def t12(t: Tables):
    return measures.outcomes(t.role("minutes"), "doc_id", "resoconto")


@query(
    "t14_duplicate_texts",
    """SELECT sha256(f) AS impronta, count(*) AS n_copie, min(doc_id) AS capofila
       FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS f FROM documents) GROUP BY 1 HAVING count(*) > 1""",
)
def t14(t: Tables):
    return measures.duplicate_texts(t.documents, "doc_id", "text")


@query(
    "t15_target_article_paragraph",
    """SELECT doc_id, CAST(doc_id % 9 + 1 AS STRING) AS articolo, CAST(doc_id % 4 + 1 AS STRING) AS comma FROM documents""",
)
def t15(t: Tables):
    number = F.concat((F.col("doc_id") % 9 + 1).cast("string"), F.lit(".7"))
    return t.role("texts").select(
        "doc_id",
        texts.target_article(number, F.lit(None).cast("string")).alias("articolo"),
        texts.target_paragraph("testo").alias("comma"),
    )
