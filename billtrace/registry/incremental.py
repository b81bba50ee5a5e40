"""Loads that can run again, file streams and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.documents import parse_bills
from ..operators.shape import only_partitions, replace_partitions
from ..streaming import check_integrity, insert_absent, insert_children, partitions_to_build, run_metrics, stream_new_files, table_counts
from .base import Tables, query
from .sources import _corpus


@query(
    "i1_skip_present_partitions",
    "SELECT id_atto, legislatura FROM acts WHERE legislatura IN (SELECT legislatura FROM acts EXCEPT SELECT legislatura FROM acts WHERE legislatura < 1998)",
    "acts",
)
def i1(t: Tables):
    acts = t.role("acts").select("id_atto", "legislatura")
    todo = partitions_to_build(acts, acts.filter("legislatura < 1998"), ["legislatura"])
    return only_partitions(acts, todo, ["legislatura"])


@query("i1_forced_partitions", "SELECT id_atto, legislatura, legislatura = 1996 AS rifatto FROM acts", "acts")
def i1_forced(t: Tables):
    acts = t.role("acts").select("id_atto", "legislatura")
    todo = partitions_to_build(acts.filter("legislatura = 1996"), acts, ["legislatura"], force=True)
    new = only_partitions(acts, todo, ["legislatura"]).withColumn("rifatto", F.lit(True))
    return replace_partitions(acts.withColumn("rifatto", F.lit(False)), new, ["legislatura"])


@query(
    "i2_insert_absent",
    """SELECT person_id, min(data_firma) AS data_firma FROM signatures WHERE person_id NOT IN (
         SELECT person_id FROM signatures WHERE sign_id % 400 = 7) GROUP BY person_id""",
    "signatures",
)
def i2(t: Tables):
    s = t.role("signatures").select("person_id", "data_firma", "sign_id")
    new = insert_absent(s.filter("sign_id % 400 = 7"), s, ["person_id"], [F.col("data_firma")])
    return new.select("person_id", "data_firma")


@query(
    "i3_insert_children",
    "SELECT id_atto, person_id, sign_id FROM signatures WHERE id_atto NOT IN (SELECT id_atto FROM signatures WHERE is_primo)",
    "signatures",
)
def i3(t: Tables):
    s = t.role("signatures").select("id_atto", "person_id", "sign_id", "is_primo")
    return insert_children(s.filter("is_primo"), s, "id_atto").drop("is_primo")


PARSED = """SELECT item_id, item_id % 7 = 0 AS is_error FROM benchmark"""


def _streamed(t: Tables, max_files: int, runs: int):
    root, out, checkpoint = _corpus(t, "stream-in"), t.scratch("stream-out"), t.scratch("stream-state")
    for _ in range(runs):
        stream_new_files(t.spark, root, parse_bills, out, checkpoint, "*.txt", max_files).awaitTermination()
    return t.spark.read.parquet(out).select(
        F.regexp_extract("path", r"item=(\d+)", 1).cast("bigint").alias("item_id"), F.col("error").isNotNull().alias("is_error")
    )


@query("i4_parse_new_files", PARSED)
def i4(t: Tables):
    return _streamed(t, 500, runs=2)


@query("i5_bounded_batches", PARSED)
def i5(t: Tables):
    return _streamed(t, 100, runs=1)


@query(
    "i6_integrity_check",
    """SELECT a.id_atto, coalesce(s.n, 0) AS n, coalesce(s.nn, CASE WHEN s.n IS NULL THEN NULL ELSE 0 END) AS n_null_persona, a.n_atteso
       FROM (SELECT id_atto, id_atto % 8 AS n_atteso FROM acts) a
       FULL JOIN (SELECT id_atto, count(*) AS n, count(*) FILTER (person_id % 50 = 0) AS nn FROM signatures GROUP BY id_atto) s ON a.id_atto = s.id_atto
       WHERE coalesce(s.nn, 0) > 0 OR coalesce(s.n, 0) IS DISTINCT FROM a.n_atteso""",
    "acts signatures",
)
def i6(t: Tables):
    s = t.role("signatures").select("id_atto", F.when(F.col("person_id") % 50 != 0, F.col("person_id")).alias("persona"))
    expected = t.role("acts").select("id_atto", (F.col("id_atto") % 8).alias("n_atteso"))
    return check_integrity(s, ["persona"], ["id_atto"], expected)


@query(
    "i7_run_metrics",
    """SELECT r.legislatura, count(a.id_atto) AS n, count(*) FILTER (a.importo > 200000) AS n_grandi,
              CASE WHEN count(a.id_atto) > 0 THEN 'ok' ELSE 'empty' END AS status
       FROM (SELECT DISTINCT legislatura FROM acts UNION SELECT DISTINCT legislatura + 2 FROM acts) r
       LEFT JOIN acts a ON a.legislatura = r.legislatura GROUP BY r.legislatura""",
    "acts",
)
def i7(t: Tables):
    acts = t.role("acts")
    years = acts.select("legislatura").distinct()
    requested = years.union(years.select((F.col("legislatura") + 2).cast("int")))
    return run_metrics(acts, "legislatura", {"grandi": F.col("importo") > 200000}, requested)


@query(
    "i8_table_counts",
    """SELECT 'atti' AS tabella, count(*) AS n, count(natura) AS n_presenti FROM phases
       UNION ALL SELECT 'adesioni', count(*), count(fine) FROM memberships""",
    "phases memberships",
)
def i8(t: Tables):
    return table_counts({"atti": (t.role("phases"), "natura"), "adesioni": (t.role("memberships"), "fine")})
