"""Plans stay the way they are meant to run at scale."""

import pytest

from billtrace.registry import REGISTRY

SF = "/root/testdata/sf0.001"
# These start jobs while they are built; their parts are covered by the other entries.
EAGER = ("t10_similar", "t11", "i4", "i5", "s4", "s5", "s6_d", "s7", "s10", "s11", "d10", "x5")


def plan(spark, name):
    return REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in REGISTRY if not n.startswith(EAGER)])
def test_no_pairwise_join_row_udf_or_unlimited_window(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in text
    if "Window [" in text:
        assert "WindowGroupLimit" in text


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "s1_parquet_scan")
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_row_picks_are_cut_before_the_shuffle(spark):
    text = plan(spark, "w1_latest_membership")
    assert text.index("Exchange") < text.index("Partial")


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "o4_top_k")


def test_lookup_is_broadcast_when_small_and_split_when_not(spark):
    from pyspark.sql import functions as F

    from billtrace.operators.joins import attach

    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    left = spark.range(0, 300_000, 1, 8).select(hot.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    lookup = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    lookup = lookup.groupBy("k").agg(F.max("v").alias("v"))
    small = attach(left, lookup, ["k"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        large = attach(left, lookup, ["k"])
        assert large.agg(F.count("*"), F.count("v")).first()[:2] == (300_000, 300_000)
        large.write.format("noop").mode("overwrite").save()
        frame = large.repartition(4)
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_versions_are_picked_before_they_are_written(spark):
    """Acts, signers and versions use the picked bills; each use sorted and sent whole articles again."""
    from billtrace.plans.acts import build_documents
    from billtrace.registry.base import Tables
    from billtrace.registry.documents import _amendments, _bills, _persons

    t = Tables(spark, SF)
    docs = build_documents(_bills(t), _amendments(t), _persons(t), per_part=50)
    lines = docs._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("Window [row_number" in line and "versione#" in line for line in lines) == 1  # that of consolidate


def test_repairs_are_skipped_and_the_text_is_built_once(spark):
    from billtrace.operators import flatten

    bills = spark.createDataFrame(
        [("a", "ddlpres", [("x", "1", "Ã¨  vero", [("1", " lâ\u0080\u0099atto   b"), ("2", None), ("3", "c")])])],
        "atto_id string, versione string, articles array<struct<id string, num string, heading string, paragraphs array<struct<num string, text string>>>>",
    )
    rows = flatten.articles(bills)
    assert [(r.titolo, r.testo_integrale) for r in rows.collect()] == [("è vero", "l'atto b c")]
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("array_join(") == 1 and "Contains(" in text.replace("contains(", "Contains(")


def test_chamber_signers_are_sent_once_and_not_sorted(spark):
    text = plan(spark, "d5_chamber_signers")
    assert text.count("Exchange hashpartitioning(") == 1
    assert "Window" not in text and "Sort" not in text
