"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ALL=1 for every query.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from billtrace.registry import REGISTRY

HEADLINE = """
    s1_parquet_scan p11_uri_list_filter j3_fragmentation j5_asof_group j6_valid_name j8_amendment_subject_bill
    j15_star_join j18_signatures_with_group a2_filtered_counts a3_coverage_by_branch a6_signatory_summary
    a9_first_non_null a13_pivot_growth a21_coalition_tenure a22_rich_acts a32_nested_children w1_latest_membership
    w2_first_role_wins w8_state_history g4_entity_table g7_reachable_types x1_parse_bills t1_text_counts
    t10_text_distance t14_duplicate_texts t11_clusters d1_senate_bills d4_chamber_acts d10_act_proponents
    d11_growth_report d14_star_bills d15_complexity_table i2_insert_absent
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("billtrace-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(REGISTRY) if os.environ.get("BENCH_ALL") == "1" else HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("a1_counts_per_key")  # starts the session and the first tasks
    times = {name: run(name) for name in names}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
