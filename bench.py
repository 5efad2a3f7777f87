"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. BENCH_QUERIES, a
comma list, limits the run; ``all`` runs every registered query. Each query is planned and fully executed to a
sink that drops rows; the seconds are the better of two runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keystrata.catalogue import QUERIES  # noqa: E402
from keystrata.session import local_session  # noqa: E402

HEADLINE = [
    "current_view_orders",
    "current_view_multi_key",
    "current_view_link_2hubs",
    "current_view_link_3hubs",
    "current_view_link_5hubs_tz",
    "current_view_link_6hubs_8keys",
    "tmp_doms_network_outage_detail",
    "tmp_doms_spa_mv_call",
    "tmp_doms_rpt_details",
    "cdc_latest_transaction",
    "hash_link_key",
    "hash_sat_diff_decimal",
    "hub_load_two_batches",
    "link_load_two_batches",
    "sat_load_delta_check",
    "sat_load_partition_filtered",
    "vault_feed_load",
    "history_merge_reconcile",
    "upsert_customers",
    "upsert_delivery_calendar",
    "business_days",
    "count_substring_documents",
    "st_xy",
    "trans_regexp_all",
    "trans_clean_strings",
    "record_seq",
    "warehouse_staging",
    "conform_fact",
    "surrogate_keys",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.read.parquet(f"{folder}/nation.parquet").count()

    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder)}))
    spark.stop()


if __name__ == "__main__":
    main()
