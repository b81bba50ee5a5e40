"""Loads that commit as one, recover from crashes, and sources whose layout is found out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.bulletins import html_blocks
from ..operators.documents import parse_bills
from ..operators.edits import within_edits
from ..operators.minutes import voted_outcomes
from ..sources import add_path_parts, write_table
from ..sources.discovery import list_tree, write_tree
from ..sources.inference import read_csv, read_documents_evolving
from ..sources.versions import commit, load_missing, manifest, partitions, read
from ..streaming.ledger import ledger, load_files, loaded, stream_into
from .base import Tables, query

# ---- partitions and rebuilds


@query("u2_partition_commit", "SELECT id_atto, legislatura, legislatura = 1996 AS rifatto, CASE WHEN legislatura = 1996 THEN 2 ELSE 1 END AS versione FROM acts", "acts")
def u2_commit(t: Tables):
    root = t.scratch("set")
    acts = t.role("acts").select("id_atto", "legislatura")
    commit(t.spark, root, {"atti": (acts.withColumn("rifatto", F.lit(False)), ["legislatura"])})
    before = partitions(t.spark, root, "atti")
    commit(t.spark, root, {"atti": (acts.filter("legislatura = 1996").withColumn("rifatto", F.lit(True)), ["legislatura"])})
    # A partition is of the first version as long as its folder is.
    kept = partitions(t.spark, root, "atti").join(before.select("path", F.lit(1).alias("versione")), "path", "left")
    version = kept.select(F.col("legislatura").cast("int"), F.coalesce("versione", F.lit(2)).alias("versione"))
    return read(t.spark, root, "atti").join(version, "legislatura").select("id_atto", "legislatura", "rifatto", "versione")


@query(
    "i1_partition_load",
    """SELECT id_atto, legislatura, CASE WHEN legislatura % 3 = 0 THEN 3 WHEN legislatura < 1995 THEN 1 ELSE 2 END AS carico FROM acts""",
    "acts",
)
def i1_load(t: Tables):
    root, acts = t.scratch("set"), t.role("acts").select("id_atto", "legislatura")
    years = [r[0] for r in acts.select("legislatura").distinct().collect()]
    first = [y for y in years if y < 1995]
    load = lambda n, wanted, force=False: load_missing(t.spark, root, "atti", acts.withColumn("carico", F.lit(n)), "legislatura", wanted, force)
    load(1, first)
    load(2, years)  # those of the first load are skipped
    load(3, [y for y in years if y % 3 == 0], force=True)
    return read(t.spark, root, "atti")


@query(
    "s11_swapped_rebuild",
    """SELECT 'atti' AS tabella, count(*) AS n, 2 AS versione FROM orders UNION ALL SELECT 'firmatari', count(*), 2 FROM lineitem""",
)
def s11_swap(t: Tables):
    root = t.scratch("set")
    frames = {"atti": (t.role("acts"), ["legislatura"]), "firmatari": (t.role("signatures"), [])}
    commit(t.spark, root, frames | {"vecchia": (t("region"), [])}, rebuild=True)
    commit(t.spark, root, frames, rebuild=True)  # as one version, without what is gone
    now = manifest(t.spark, root)
    counts = [read(t.spark, root, name).agg(F.lit(name).alias("tabella"), F.count("*").alias("n"), F.lit(now.version).alias("versione")) for name in now.tables]
    return counts[0].unionByName(counts[1])


# ---- files


def _items(t: Tables, label: str) -> str:
    """One file per benchmark item, in a tree; its text as it stands."""
    root = t.scratch(label)
    items = t("benchmark").select(F.concat(F.lit("voce"), F.col("item_id"), F.lit("/testo.txt")).alias("path"), F.col("text").alias("content"))
    write_tree(items, root)
    return root


def _number():
    return F.regexp_extract("path", r"voce(\d+)/", 1).cast("bigint")


@query("i5_resumed_batches", "SELECT item_id, strlen(text) AS n_byte, true AS ripreso FROM benchmark")
def i5_resumed(t: Tables):
    """A stream that breaks in its second batch, dies again after a commit, and goes on each time."""
    spark, root, state = t.spark, t.scratch("set"), t.scratch("state")
    files = _items(t, "items")
    size = max(1, -(-t("benchmark").count() // 5))  # five batches

    def parser(batch):
        return batch.select("path", F.octet_length("content").cast("bigint").alias("n_byte"))

    def broken(batch):
        if "voci" in manifest(spark, root).tables:
            raise RuntimeError("broken in the second batch")
        return parser(batch)

    def dies(number: int):
        if number == 2:
            raise RuntimeError("dead between commit and checkpoint")

    faults = 0
    for step, after in ((broken, None), (parser, dies), (parser, None)):
        run = stream_into(spark, files, step, root, "voci", state, "*.txt", size, after)
        try:
            run.awaitTermination()
        except Exception:
            faults += 1
    rows = read(spark, root, "voci")
    batches = rows.select(F.count_distinct("batch")).first()[0]
    return rows.select(_number().alias("item_id"), "n_byte", F.lit(faults == 2 and batches >= 3).alias("ripreso"))


@query(
    "i4_ledger_reparse",
    """SELECT item_id, text AS testo, CAST(CASE WHEN item_id % 7 = 0 OR strlen(text) < 200 THEN 2 ELSE 1 END AS INTEGER) AS tentativi FROM benchmark""",
)
def i4_ledger(t: Tables):
    """Every seventh output is a stub at first; the next run parses the small ones again, and no others."""
    spark, root, files = t.spark, t.scratch("set"), _items(t, "items")
    text = F.decode("content", "UTF-8")

    def stub(batch):
        return batch.select("path", F.when(_number() % 7 == 0, F.substring(text, 1, 20)).otherwise(text).alias("testo"))

    load_files(spark, files, stub, root, "voci", F.octet_length("testo"), "*.txt", max_files=25)
    for _ in range(2):  # the second finds nothing to do
        load_files(spark, files, lambda batch: batch.select("path", text.alias("testo")), root, "voci", F.octet_length("testo"), "*.txt", max_files=25)
    rows = loaded(spark, root, "voci").join(ledger(spark, root, "voci").select("path", F.col("tries").alias("tentativi")), "path")
    return rows.select(_number().alias("item_id"), "testo", "tentativi")


@query(
    "s2_inferred_csv",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey = (SELECT max(c_custkey) FROM customer) THEN 'n/d' ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey,
              c_acctbal, c_mktsegment, DATE '1992-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS iscritto, c_custkey % 2 = 0 AS attivo
       FROM customer""",
)
def s2_inferred(t: Tables):
    """One late bad value makes its column text; the others get their types."""
    path, customers = t.scratch("csv"), t("customer")
    last = customers.agg(F.max("c_custkey").alias("__last"))
    rows = customers.join(F.broadcast(last), F.col("c_custkey") == F.col("__last"), "left").withColumn(
        "c_nationkey", F.when(F.col("__last").isNotNull(), "n/d").otherwise(F.col("c_nationkey").cast("string"))
    )
    rows = rows.drop("__last").withColumns({"iscritto": F.date_add(F.lit("1992-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")), "attivo": F.col("c_custkey") % 2 == 0})
    write_table(rows, path, fmt="csv")
    return read_csv(t.spark, path)


@query(
    "s3_whole_documents",
    """SELECT conv_id, CASE WHEN conv_id % 50 <> 0 THEN count(*) END AS n_turni, CASE WHEN conv_id % 50 <> 0 THEN sum(strlen(text)) END AS n_byte,
              CASE WHEN conv_id % 50 <> 0 AND conv_id % 3 = 0 THEN 'it' END AS lingua, conv_id % 50 = 0 AS rotto
       FROM conversations GROUP BY conv_id""",
)
def s3_whole(t: Tables):
    """One nested document per file over many lines; a third has a later layout, every fiftieth is cut short."""
    root = t.scratch("documents")
    turns = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turni"))
    meta = F.when(F.col("conv_id") % 3 == 0, F.struct(F.lit("it").alias("lingua")))
    whole = F.to_json(F.struct("conv_id", "turni", meta.alias("meta")), {"pretty": "true"})
    cut = F.when(F.col("conv_id") % 50 == 0, F.substring(whole, 1, 30)).otherwise(whole)
    write_tree(turns.select(F.concat(F.lit("d"), F.col("conv_id"), F.lit("/documento.json")).alias("path"), cut.alias("content")), root)
    found = read_documents_evolving(t.spark, root)
    number = F.regexp_extract("path", r"/d(\d+)/", 1).cast("bigint")
    sizes = F.aggregate("turni", F.lit(0).cast("bigint"), lambda s, x: s + F.octet_length(x["text"]))
    return found.select(
        number.alias("conv_id"), F.nullif(F.size("turni"), F.lit(-1)).cast("bigint").alias("n_turni"), sizes.alias("n_byte"), F.col("meta.lingua").alias("lingua"), F.col("_corrotto").isNotNull().alias("rotto")
    )


@query(
    "s6_discovered_tree",
    """SELECT CAST(c_nationkey + 1 AS INTEGER) AS legislatura, concat('Atto', c_custkey // 5) AS atto_id, CASE c_custkey % 3 WHEN 0 THEN 'ddlpres' WHEN 1 THEN 'emendc' ELSE 'resaula' END AS kind,
              concat(c_custkey, '.akn.xml') AS file_name, strlen(c_name) AS n_byte FROM customer""",
)
def s6_tree(t: Tables):
    """A real tree, listed level by level on the executors."""
    root, key = t.scratch("tree"), F.col("c_custkey")
    kind = F.element_at(F.array(F.lit("ddlpres"), F.lit("emendc"), F.lit("resaula")), (key % 3 + 1).cast("int"))
    parts = [F.lit("Leg"), F.col("c_nationkey") + 1, F.lit("/Atto"), F.floor(key / 5), F.lit("/"), kind, F.lit("/"), key, F.lit(".akn.xml")]
    write_tree(t("customer").select(F.concat(*parts).alias("path"), F.col("c_name").alias("content")), root)
    found = add_path_parts(list_tree(t.spark, root, "*.akn.xml"))
    return found.select("legislatura", "atto_id", "kind", "file_name", F.col("length").alias("n_byte"))


# ---- texts

TITLES = r"""
    SELECT regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[^ -~]', '', 'g') AS titolo FROM pages
    UNION ALL SELECT p_name FROM part UNION ALL SELECT s_name FROM supplier UNION ALL SELECT n_name FROM nation UNION ALL SELECT r_name FROM region"""


@query(
    "t10_title_edits",
    f"""WITH t AS (SELECT titolo, count(*) AS n FROM ({TITLES}) GROUP BY titolo)
       SELECT x.titolo AS a, y.titolo AS b, CAST(levenshtein(x.titolo, y.titolo) AS INTEGER) AS distanza, x.n AS righe_a, y.n AS righe_b
       FROM t x JOIN t y ON x.titolo < y.titolo AND abs(strlen(x.titolo) - strlen(y.titolo)) <= 2 AND levenshtein(x.titolo, y.titolo) <= 2""",
)
def t10_titles(t: Tables):
    plain = F.regexp_replace(F.regexp_extract("html", "<title>([^<]*)</title>", 1), "[^ -~]", "")
    titles = t("pages").select(plain.alias("titolo"))
    for table, column in (("part", "p_name"), ("supplier", "s_name"), ("nation", "n_name"), ("region", "r_name")):
        titles = titles.union(t(table).select(column))
    return within_edits(titles, "titolo", 2)


@query(
    "t12_outcome_lists",
    """WITH n AS (SELECT o_orderkey AS k, o_orderkey % 9 + 1 AS a, o_orderkey % 5 AS r, o_orderkey % 4 AS w FROM orders)
       SELECT k AS id_seduta, 1 AS passo, 'emendamento' AS tipo, concat(a, '.', i) AS numero, 'respinto' AS esito
       FROM (SELECT *, unnest(list_concat([1, 2], range(4, 5 + r))) AS i FROM n)
       UNION ALL SELECT k, 2, 'articolo', CAST(a AS VARCHAR), CASE w WHEN 0 THEN 'approvato' WHEN 1 THEN 'respinto' WHEN 2 THEN 'accantonato' ELSE 'approvato' END FROM n
       UNION ALL SELECT k, 3, 'subemendamento', unnest([concat('0.', a, '.1'), concat('0.', a, '.2-bis')]), 'ritirato' FROM n WHERE r > 1
       UNION ALL SELECT k, 4, 'emendamento', unnest([concat(a, '.9'), concat(a + 1, '.2')]), 'inammissibile' FROM n WHERE r > 1""",
)
def t12_lists(t: Tables):
    article, width = F.col("o_orderkey") % 9 + 1, F.col("o_orderkey") % 5
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    text = F.concat_ws(
        " ",
        say("La seduta riprende. Gli emendamenti ", article, ".1, ", article, ".2 e da ", article, ".4 a ", article, ".", width + 4, " sono respinti. Presidente: "),
        F.col("o_orderpriority"),
        F.element_at(
            F.array(say(". È approvato? L'articolo ", article, " è stato approvato"), say("; l'articolo ", article, "\n non è approvato"), say(". L’ARTICOLO ", article, " viene accantonato"), say(" L'articolo ", article, " risulta approvato")),
            (F.col("o_orderkey") % 4 + 1).cast("int"),
        ),
        F.when(width > 1, say(", mentre i subemendamenti 0.", article, ".1 e 0.", article, ".2-bis sono ritirati; da ", article, ".9 a ", article + 1, ".2 nulla. Emendamenti da ", article, ".9 a ", article + 1, ".2 sono dichiarati inammissibili.")),
    )
    return voted_outcomes(t("orders").select(F.col("o_orderkey").alias("id_seduta"), text.alias("testo")), "id_seduta", "testo")


@query(
    "x9_html_blocks",
    r"""WITH p AS (SELECT page_id, string_split(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<(script|style)>.*?</(script|style)>', '', 'gs'), '<a href="') AS pieces FROM pages),
       b AS (SELECT page_id, generate_subscripts(pieces, 1) - 2 AS posizione, unnest(pieces) AS piece FROM p)
       SELECT page_id, CAST(posizione AS INTEGER) AS posizione, split_part(piece, '"', 1) AS ancora, 'a' AS elemento,
              trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(piece, '^[^>]*>', ''), '</?(a|b)( [^>]*)?>', '', 'g'), '<[^>]+>', ' ', 'g'),
                '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&amp;', '&'), '\s+', ' ', 'g')) AS testo
       FROM b WHERE posizione >= 0""",
)
def x9_blocks(t: Tables):
    """The pages as they stand, with the anchors they hold."""
    blocks = t("pages").select("page_id", F.posexplode(html_blocks("html", ["name", "id", "href"])).alias("posizione", "b"))
    return blocks.select("page_id", "posizione", "b.ancora", "b.elemento", "b.testo")


@query(
    "i5_streamed_bills",
    """SELECT item_id, len(string_split(text, chr(10))) AS n_commi FROM benchmark""",
)
def i5_bills(t: Tables):
    """Bills as XML files through the recoverable stream, in batches of a few files."""
    from .xml import bill_files

    root, files, state = t.scratch("set"), t.scratch("bills"), t.scratch("state")
    bills = bill_files(t("benchmark").select(F.col("item_id").alias("doc_id"), "text"))
    write_tree(bills.select(F.concat(F.lit("voce"), F.col("doc_id"), F.lit("/b.akn.xml")).alias("path"), F.decode("content", "UTF-8").alias("content")), files)
    stream_into(t.spark, files, parse_bills, root, "ddl", state, "*.xml", max_files=16).awaitTermination()
    return read(t.spark, root, "ddl").select(_number().alias("item_id"), F.size(F.col("articles")[0]["paragraphs"]).cast("bigint").alias("n_commi"))
