"""Scans and sinks: what is written must read back the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.documents import parse_bills
from ..sources import (
    add_path_parts,
    create_tables,
    read_files,
    read_ntriples,
    read_table,
    rebuild_tables,
    sidecar,
    write_table,
)
from .base import Tables, query
from .xml import bill_files


@query("s1_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")
def s1(t: Tables):
    df = read_table(t.spark, f"{t.sf_dir}/orders.parquet")
    return df.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)).select("o_orderkey", "o_totalprice")


CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _customer_schema(t):
    return t.spark.createDataFrame([], CUSTOMER).schema


@query("s2_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s2(t: Tables):
    path = t.scratch("csv")
    write_table(t("customer"), path, fmt="csv")
    return read_table(t.spark, path, _customer_schema(t), "csv")


@query("s3_json_scan", "SELECT conv_id, turn, role, text FROM conversations")
def s3(t: Tables):
    path = t.scratch("json")
    write_table(t("conversations"), path, fmt="json")
    schema = t.spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string").schema
    return read_table(t.spark, path, schema, "json")


def _corpus(t: Tables, label: str) -> str:
    """Benchmark items as one XML file each; every seventh is cut short."""
    items = bill_files(t("benchmark").select(F.col("item_id").alias("doc_id"), "text"))
    xml = F.decode("content", "UTF-8")
    cut = F.when(F.col("doc_id") % 7 == 0, F.substring(xml, 1, 60)).otherwise(xml)
    path = t.scratch(label)
    items.select(F.col("doc_id").alias("item"), F.regexp_replace(cut, "[\r\n]", " ").alias("value")).write.partitionBy(
        "item"
    ).text(path)
    return path


@query(
    "s4_xml_corpus_scan",
    """SELECT item_id, item_id % 7 = 0 AS is_error,
              CASE WHEN item_id % 7 = 0 THEN NULL ELSE len(string_split(text, chr(10))) END AS n_commi
       FROM benchmark""",
)
def s4(t: Tables):
    parsed = parse_bills(read_files(t.spark, _corpus(t, "xml"), "*.txt"))
    return parsed.select(
        F.regexp_extract("path", r"item=(\d+)", 1).cast("bigint").alias("item_id"),
        F.col("error").isNotNull().alias("is_error"),
        F.when(F.col("error").isNull(), F.size(F.col("articles")[0]["paragraphs"])).alias("n_commi"),
    )


@query("s5_ntriples_scan", "SELECT s, p, o, o_kind, o_datatype, CAST(NULL AS STRING) AS error FROM triples", "triples")
def s5(t: Tables):
    def iri(c):
        return F.when(F.startswith(F.col(c), F.lit("_:")), F.col(c)).otherwise(F.concat(F.lit("<"), F.col(c), F.lit(">")))

    literal = F.concat(F.lit('"'), F.col("o"), F.lit('"'), F.coalesce(F.concat(F.lit("^^<"), F.col("o_datatype"), F.lit(">")), F.lit("")))
    line = F.concat_ws(
        " ", iri("s"), F.concat(F.lit("<"), F.col("p"), F.lit(">")),
        F.when(F.col("o_kind") == "literal", literal).otherwise(iri("o")), F.lit("."),
    )
    path = t.scratch("nt")
    t.role("triples").select(line.alias("value")).write.text(path)
    return read_ntriples(t.spark, path)


@query(
    "s6_partition_discovery",
    """SELECT path, CAST(nullif(regexp_extract(path, 'Leg(\\d+)', 1), '') AS INTEGER) AS legislatura,
              nullif(regexp_extract(path, 'Leg\\d+/(Atto[^/]*)', 1), '') AS atto_id,
              nullif(regexp_extract(path, 'Leg\\d+/Atto[^/]*/([^/]+)', 1), '') AS kind,
              nullif(regexp_extract(path, '([^/]+)$', 1), '') AS file_name
       FROM paths""",
    "paths",
)
def s6(t: Tables):
    return add_path_parts(t.role("paths"))


@query("s7_parquet_sink", "SELECT * FROM acts", "acts")
def s7(t: Tables):
    path = t.scratch("parquet")
    write_table(t.role("acts"), path, partition_by=["legislatura"])
    return read_table(t.spark, path)


@query("s8_csv_sink", "SELECT c_name, c_custkey FROM customer")
def s8(t: Tables):
    path = t.scratch("csv-order")
    write_table(t("customer"), path, fmt="csv", columns=["c_name", "c_custkey"])
    schema = t.spark.createDataFrame([], "c_name string, c_custkey bigint").schema
    return read_table(t.spark, path, schema, "csv")


@query("s9_json_sink", "SELECT p_partkey, p_name, p_size FROM part")
def s9(t: Tables):
    path = t.scratch("json-part")
    write_table(t("part").select("p_partkey", "p_name", "p_size"), path, fmt="json")
    schema = t.spark.createDataFrame([], "p_partkey bigint, p_name string, p_size int").schema
    return read_table(t.spark, path, schema, "json")


@query("s10_create_tables", "SELECT CAST(id_atto AS STRING) AS atto_id, CAST(legislatura AS STRING) AS legislatura FROM acts", "acts")
def s10(t: Tables):
    path = t.scratch("db")
    database = "db_" + path.rsplit("-", 1)[-1]
    create_tables(t.spark, database, location=path)
    create_tables(t.spark, database, location=path)  # the second call finds them there
    rows = t.role("acts").select(F.col("id_atto").cast("string"), F.col("legislatura").cast("string"))
    rows.write.insertInto(f"{database}.t_atti")
    return t.spark.table(f"{database}.t_atti")


@query(
    "s11_rebuild_tables",
    "SELECT 'atti' AS tabella, count(*) AS n FROM orders UNION ALL SELECT 'firmatari', count(*) FROM lineitem",
)
def s11(t: Tables):
    path = t.scratch("star")
    database = "db_" + path.rsplit("-", 1)[-1]
    frames = {"atti": t.role("acts"), "firmatari": t.role("signatures")}
    rebuild_tables(t.spark, database, frames, location=path)
    return rebuild_tables(t.spark, database, frames, location=path)


@query(
    "s12_sidecar",
    """SELECT url AS path, 'corpus' AS fonte, CAST(strlen(html) AS BIGINT) AS size_bytes, sha256(html) AS sha256,
              regexp_extract(url, '([^/]*)$', 1) AS coda FROM pages""",
)
def s12(t: Tables):
    out = sidecar(t("pages"), "corpus", path="url", content="html")
    return out.withColumn("coda", F.substring_index("path", "/", -1))

