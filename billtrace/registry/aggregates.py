"""Aggregates, coverage and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import DOCUMENT_KINDS
from ..operators import coverage as cov
from ..operators.flatten import nest
from ..operators.measures import growth
from ..operators.signatories import cosigner_counts, procedure_dates, signatory_summary
from ..sources import add_path_parts
from .base import Tables, pct, query
from .joins import GROWTH


@query(
    "a2_filtered_counts",
    """SELECT id_atto, count(DISTINCT person_id) AS n, count(DISTINCT CASE WHEN data_firma >= DATE '1998-01-01' THEN person_id END) AS n_tardi
       FROM signatures GROUP BY id_atto""",
    "signatures",
)
def a2(t: Tables):
    late = F.when(F.col("data_firma") >= F.lit("1998-01-01").cast("date"), F.col("person_id"))
    return t.role("signatures").groupBy("id_atto").agg(
        F.countDistinct("person_id").alias("n"), F.countDistinct(late).alias("n_tardi")
    )


@query(
    "a3_coverage_by_branch",
    f"""SELECT legislatura, ramo_origine, count(*) AS n_ddl, count(*) FILTER (has_testo_presentato) AS n_testo,
              count(*) FILTER (has_emendamenti) AS n_emend, CAST(sum(n_emendamenti) AS BIGINT) AS n_emendamenti_totali,
              {pct("count(*) FILTER (has_testo_presentato)", "count(*)")} AS pct_testo
       FROM phases GROUP BY legislatura, ramo_origine""",
    "phases",
)
def a3(t: Tables):
    return cov.coverage(
        t.role("phases"),
        ["legislatura", "ramo_origine"],
        {"testo": F.col("has_testo_presentato"), "emend": F.col("has_emendamenti")},
        sums={"n_emendamenti_totali": F.col("n_emendamenti")},
        percents=["testo"],
        total="n_ddl",
    )


@query(
    "a4_coverage_by_legislature",
    f"""SELECT leg AS legislatura, count(*) AS n_atti, count(*) FILTER (has_testo_presentato) AS n_testo, count(natura) AS n_natura,
              count(*) FILTER (n_emendamenti > 0) AS n_emend, {pct("count(*) FILTER (has_testo_presentato)", "count(*)")} AS pct_testo,
              {pct("count(natura)", "count(*)")} AS pct_natura
       FROM (SELECT *, nullif(legislatura, 1997) AS leg FROM phases) WHERE leg IS NOT NULL GROUP BY leg""",
    "phases",
)
def a4(t: Tables):
    df = t.role("phases").withColumn("legislatura", F.nullif("legislatura", F.lit(1997)))
    return cov.coverage(
        df,
        ["legislatura"],
        {"testo": F.col("has_testo_presentato"), "natura": F.col("natura").isNotNull(), "emend": F.col("n_emendamenti") > 0},
        percents=["testo", "natura"],
        total="n_atti",
        keep_null_groups=False,
    )


@query(
    "a5_percent",
    f"""SELECT id_ddl, {pct("count(*) FILTER (natura = '5-LOW')", "count(*)")} AS pct_low,
              {pct("count(*) FILTER (natura = '1-URGENT')", "count(*) FILTER (ramo_origine = 'F')")} AS pct_guard FROM acts GROUP BY id_ddl""",
    "acts",
)
def a5(t: Tables):
    return t.role("acts").groupBy("id_ddl").agg(
        cov.percent(cov.count_if(F.col("natura") == "5-LOW"), F.count("*")).alias("pct_low"),
        cov.percent(cov.count_if(F.col("natura") == "1-URGENT"), cov.count_if(F.col("ramo_origine") == "F")).alias("pct_guard"),
    )


@query(
    "a6_signatory_summary",
    """SELECT id_atto, min(CASE WHEN is_primo THEN person_id END) AS primo_firmatario_uri,
              CASE WHEN min(CASE WHEN is_primo THEN person_id END) IS NULL THEN NULL ELSE concat('P', min(CASE WHEN is_primo THEN person_id END)) END AS primo_firmatario_nome,
              count(DISTINCT CASE WHEN NOT is_primo THEN person_id END) AS n_cofirmatari
       FROM signatures GROUP BY id_atto""",
    "signatures",
)
def a6(t: Tables):
    s = t.role("signatures").withColumn("nome", F.concat(F.lit("P"), F.col("person_id")))
    return signatory_summary(s, "id_atto", "person_id", "nome", "is_primo")


@query(
    "a7_cosigner_counts",
    """SELECT id_atto, count(CASE WHEN NOT is_primo AND person_id % 3 <> 0 THEN 1 END) AS n_cofirmatari,
              count(CASE WHEN NOT is_primo THEN 1 END) AS n_cofirmatari_totale FROM signatures GROUP BY id_atto""",
    "signatures",
)
def a7(t: Tables):
    s = t.role("signatures").withColumn("person_id", F.when(F.col("person_id") % 3 != 0, F.col("person_id")))
    return cosigner_counts(s, "id_atto", "person_id", "is_primo")


@query(
    "a8_procedure_dates",
    """SELECT id_atto, min(si_date) FILTER (si_label = 'Da assegnare') AS data_prima_assegnazione,
              min(si_date) FILTER (si_label = 'Approvato definitivamente. Legge') AS data_approvazione
       FROM states WHERE si_label <> 'In corso' GROUP BY id_atto""",
    "states",
)
def a8(t: Tables):
    return procedure_dates(t.role("states"), "id_atto", "si_label", "si_date")


@query("a10_value_counts", "SELECT natura, ramo_origine, count(*) AS n FROM phases GROUP BY natura, ramo_origine", "phases")
def a10(t: Tables):
    return cov.value_counts(t.role("phases"), ["natura", "ramo_origine"])


PHASE_SUMMARY = f"""SELECT legislatura, count(id_fase) AS righe_totali, count(DISTINCT id_ddl_interno) AS ddl_unici_idddl,
              count(*) FILTER (is_prima_fase) AS prime_fasi, count(*) FILTER (ramo_origine = 'S') AS "ramo_S",
              count(*) FILTER (ramo_origine = 'C') AS "ramo_C", count(*) FILTER (has_testo_presentato) AS has_testo_pres,
              count(*) FILTER (has_emendamenti) AS has_emend,
              round_even(CAST(count(id_fase) AS DOUBLE) / count(DISTINCT id_ddl_interno), 2) AS fasi_per_ddl,
              {pct("(count(id_fase) - count(*) FILTER (is_prima_fase))", "count(id_fase)")} AS pct_multifase
       FROM phases GROUP BY legislatura"""


@query("a11_phase_summary", PHASE_SUMMARY, "phases")
def a11(t: Tables):
    return cov.phase_summary(t.role("phases"))


PHASE_PIVOT = """SELECT legislatura, count(*) FILTER (progressivo_iter = 1) AS iter_1, count(*) FILTER (progressivo_iter = 2) AS iter_2,
              count(*) FILTER (progressivo_iter = 3) AS iter_3, count(*) FILTER (progressivo_iter = 4) AS iter_4 FROM phases GROUP BY legislatura"""


@query("a12_phase_pivot", PHASE_PIVOT, "phases")
def a12(t: Tables):
    return cov.pivot_counts(t.role("phases"), ["legislatura"], "progressivo_iter", [1, 2, 3, 4], "iter_")


@query("a13_pivot_growth", GROWTH, "articles")
def a13(t: Tables):
    return growth(t.role("articles"))


@query("t7_growth", GROWTH.replace("'ddlpres'", "'ddlcomm'").replace("ddlpres", "ddlcomm"), "articles")
def t7(t: Tables):
    return growth(t.role("articles"), start="ddlcomm")


@query(
    "a14_multiplicity",
    "SELECT n_item, count(*) AS n_chiavi FROM (SELECT id_atto, count(*) AS n_item FROM signatures GROUP BY id_atto) GROUP BY n_item",
    "signatures",
)
def a14(t: Tables):
    return cov.multiplicity(t.role("signatures"), "id_atto")


@query(
    "a15_having",
    "SELECT id_ddl, count(*) AS n, min(natura) AS prima FROM acts GROUP BY id_ddl HAVING count(*) > 14 AND min(natura) LIKE '1%'",
    "acts",
)
def a15(t: Tables):
    out = t.role("acts").groupBy("id_ddl").agg(F.count("*").alias("n"), F.min("natura").alias("prima"))
    return out.filter((F.col("n") > 14) & F.startswith(F.col("prima"), F.lit("1")))


@query(
    "a16_signer_histogram",
    """SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 3 THEN '2-3' WHEN n <= 5 THEN '4-5' WHEN n <= 10 THEN '6-10' WHEN n <= 20 THEN '11-20' ELSE '21+' END AS bucket,
              count(*) AS n FROM (SELECT count(*) AS n FROM signatures GROUP BY id_atto) GROUP BY 1""",
    "signatures",
)
def a16(t: Tables):
    per_act = t.role("signatures").groupBy("id_atto").agg(F.count("*").alias("n_firme"))
    return cov.histogram(per_act, "n_firme")


@query(
    "a16_signer_count_stats",
    """SELECT count(*) AS n, max(n) AS massimo, round_even(avg(n), 1) AS media, list_sort(list(n))[len(list(n)) // 2 + 1] AS mediana
       FROM (SELECT count(*) AS n FROM signatures GROUP BY id_atto)""",
    "signatures",
)
def a16_stats(t: Tables):
    per_act = t.role("signatures").groupBy("id_atto").agg(F.count("*").alias("n_firme"))
    return cov.count_stats(per_act, "n_firme")


@query(
    "a18_indicator_overlap",
    f"""SELECT lang, count(*) AS n_tot, count(*) FILTER (a) AS n_a, count(*) FILTER (b) AS n_b, count(*) FILTER (a AND b) AS n_both,
              count(*) FILTER (a AND NOT b) AS n_solo_a, count(*) FILTER (b AND NOT a) AS n_solo_b, count(*) FILTER (NOT a AND NOT b) AS n_nessuno,
              {pct("count(*) FILTER (a)", "count(*)")} AS pct_a, {pct("count(*) FILTER (b)", "count(*)")} AS pct_b
       FROM (SELECT lang, quality = 1 AS a, toxic = 1 AS b FROM documents JOIN labels USING (doc_id)) GROUP BY lang""",
)
def a18(t: Tables):
    df = t("labels").join(t.documents.select("doc_id", "lang"), "doc_id")
    return cov.overlap(df, F.col("quality") == 1, F.col("toxic") == 1, ["lang"])


@query(
    "a19_reconcile",
    f"""SELECT c.legislatura, c.n_atteso, coalesce(m.n, 0) AS n_misurato, c.n_atteso - coalesce(m.n, 0) AS gap, {pct("coalesce(m.n, 0)", "c.n_atteso")} AS pct_cov
       FROM (SELECT legislatura, CAST(sum(id_atto % 12) * (legislatura % 2) AS BIGINT) AS n_atteso FROM acts GROUP BY legislatura
             UNION ALL SELECT max(legislatura) + 1, 10 FROM acts) c
       LEFT JOIN (SELECT legislatura, CAST(sum(n_emendamenti) AS BIGINT) AS n FROM phases GROUP BY legislatura) m ON c.legislatura = m.legislatura""",
    "acts phases",
)
def a19(t: Tables):
    acts = t.role("acts")
    control = acts.groupBy("legislatura").agg(F.sum(F.col("id_atto") % 12).alias("n"))
    control = control.select("legislatura", (F.col("n") * (F.col("legislatura") % 2)).alias("n_atteso"))
    later = acts.agg((F.max("legislatura") + 1).alias("legislatura"), F.lit(10).cast("bigint").alias("n_atteso"))
    return cov.reconcile(t.role("phases"), control.union(later), "legislatura", "n_emendamenti", "n_atteso")


@query(
    "a20_cross_tab",
    """SELECT legislatura, CAST(sum(CASE WHEN ramo_origine = 'S' AND is_prima_fase THEN n_emendamenti ELSE 0 END) AS BIGINT) AS s_prima,
              CAST(sum(CASE WHEN ramo_origine = 'S' AND NOT is_prima_fase THEN n_emendamenti ELSE 0 END) AS BIGINT) AS s_poi,
              CAST(sum(CASE WHEN ramo_origine = 'C' AND is_prima_fase THEN n_emendamenti ELSE 0 END) AS BIGINT) AS c_prima,
              CAST(sum(CASE WHEN ramo_origine = 'C' AND NOT is_prima_fase THEN n_emendamenti ELSE 0 END) AS BIGINT) AS c_poi
       FROM phases GROUP BY legislatura""",
    "phases",
)
def a20(t: Tables):
    first, s, c = F.col("is_prima_fase"), F.col("ramo_origine") == "S", F.col("ramo_origine") == "C"
    cells = {"s_prima": s & first, "s_poi": s & ~first, "c_prima": c & first, "c_poi": c & ~first}
    return cov.cross_tab(t.role("phases"), ["legislatura"], "n_emendamenti", cells)


PATH_PARTS = """SELECT path, CAST(nullif(regexp_extract(path, 'Leg(\\d+)', 1), '') AS INTEGER) AS legislatura,
              nullif(regexp_extract(path, 'Leg\\d+/(Atto[^/]*)', 1), '') AS atto_id,
              nullif(regexp_extract(path, 'Leg\\d+/Atto[^/]*/([^/]+)', 1), '') AS kind FROM paths"""
KINDS = ", ".join(f"'{k}'" for k in DOCUMENT_KINDS)


@query(
    "a22_rich_acts",
    f"""SELECT atto_id, CAST(n AS INTEGER) AS n_dirs, xml_files, readme FROM (
         SELECT atto_id, count(DISTINCT kind) FILTER (kind IN ({KINDS})) AS n, count(*) FILTER (path LIKE '%.akn.xml') AS xml_files,
                bool_or(upper(kind) = 'README.MD') AS readme FROM ({PATH_PARTS}) WHERE kind IS NOT NULL GROUP BY atto_id)
       WHERE n >= 3 ORDER BY n DESC, xml_files DESC, atto_id LIMIT 30""",
    "paths",
)
def a22(t: Tables):
    out = cov.rich_acts(add_path_parts(t.role("paths")), DOCUMENT_KINDS, 3, 30)
    return out.select("atto_id", F.size("interesting_dirs").alias("n_dirs"), "xml_files", "readme")


INVENTORY = "SELECT legislatura, atto_id, " + ", ".join(
    f"coalesce(bool_or(kind = '{k}'), false) AS has_{k}" for k in DOCUMENT_KINDS
) + f" FROM ({PATH_PARTS}) GROUP BY legislatura, atto_id"


@query("d12_inventory", INVENTORY, "paths")
def d12(t: Tables):
    return cov.inventory(add_path_parts(t.role("paths")), DOCUMENT_KINDS)


@query(
    "a23_inventory_summary",
    f"""SELECT legislatura, count(*) AS n_atti, count(*) FILTER (has_emend OR has_emendc) AS n_con_emendamenti,
              count(*) FILTER ((has_emend OR has_emendc) AND has_ddlpres) AS n_processabili FROM ({INVENTORY}) GROUP BY ROLLUP (legislatura)""",
    "paths",
)
def a23(t: Tables):
    return cov.inventory_summary(cov.inventory(add_path_parts(t.role("paths")), DOCUMENT_KINDS))


@query(
    "a24_grouping_sets",
    """SELECT legislatura, ramo_origine, progressivo_iter, CAST(grouping_id(legislatura, ramo_origine, progressivo_iter) AS BIGINT) AS livello,
              count(*) AS n, count(*) FILTER (has_testo_presentato) AS n_testo FROM phases
       GROUP BY GROUPING SETS ((legislatura), (legislatura, ramo_origine), (legislatura, progressivo_iter))""",
    "phases",
)
def a24(t: Tables):
    keys = [F.col(c) for c in ("legislatura", "ramo_origine", "progressivo_iter")]
    sets = [[keys[0]], [keys[0], keys[1]], [keys[0], keys[2]]]
    return t.role("phases").groupingSets(sets, *keys).agg(
        F.grouping_id(*keys).alias("livello"), F.count("*").alias("n"), cov.count_if(F.col("has_testo_presentato")).alias("n_testo")
    )


KEY_AGREEMENT = f"""SELECT count(*) AS n, count(*) FILTER (id_fase_sparql IS NULL) AS n_null,
              {pct("count(*) FILTER (id_fase_sparql IS NULL)", "count(*)")} AS pct_null, count(*) FILTER (id_fase = id_fase_sparql) AS n_uguali FROM phases"""


@query("a27_key_agreement", KEY_AGREEMENT, "phases")
def a27(t: Tables):
    return cov.key_agreement(t.role("phases"), "id_fase", "id_fase_sparql")


@query(
    "a32_nested_children",
    """SELECT id_atto, count(*) AS n_figli, CAST(sum(person_id) AS BIGINT) AS somma, min(data_firma) AS prima FROM signatures GROUP BY id_atto""",
    "signatures",
)
def a32(t: Tables):
    """Children nested in parts of about 3, then measured again: nothing is lost or doubled."""
    child = F.struct("person_id", "data_firma")
    parts = nest(t.role("signatures"), "id_atto", child, F.col("sign_id"), "firme", per_part=3)
    sums = parts.select(
        "id_atto",
        F.size("firme").alias("n"),
        F.aggregate("firme", F.lit(0).cast("bigint"), lambda acc, x: acc + x["person_id"]).alias("s"),
        F.array_min(F.transform("firme", lambda x: x["data_firma"])).alias("d"),
    )
    return sums.groupBy("id_atto").agg(
        F.sum("n").alias("n_figli"), F.sum("s").alias("somma"), F.min("d").alias("prima")
    )
