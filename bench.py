"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.registry import catalog
from tidemark.session import local_session
from tidemark.tables import Tables

HEADLINE = [
    "flt_date_between_daily", "flt_in_list",
    "join_star_two_dims", "join_broadcast_segment", "join_fact_fact_balance", "join_multi_conditional",
    "join_semi_later_larger", "join_semi_later_larger_window", "join_interval_events", "join_self_using",
    "sub_scalar_correlated", "sub_cte_rewrite",
    "agg_key_having_top", "agg_account_profile", "agg_count_distinct_multi", "agg_of_agg_segments", "agg_find_duplicates",
    "win_lead_growth", "win_latest_per_key", "win_ntile_rfm", "win_sum_of_sum",
    "top_products_revenue", "top_customers_spend",
    "json_shred_relational", "xml_items_explode", "dq_validate_clean", "dq_report",
    "load_upsert", "load_scd2_bulk", "dedup_keep_latest", "agg_refresh_daily",
    "mart_sales_by_category", "mart_category_year", "mart_period_growth", "mart_rfm_segments", "mart_campaign_roi",
    "snk_partitioned_monthly", "src_csv_typed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, partitions=int(cores) if cores.isdigit() else 8)
    entries, tables = catalog(), Tables(spark, sf_dir)
    # One throw-away run, so that the first query does not pay for starting the engine.
    entries[HEADLINE[2]].run(tables).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        entries[name].run(tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
