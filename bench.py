"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
local threads. Every query runs from the source tables to its full result, which is
written to a sink that discards it; each is run twice and the faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forumlens.catalog import QUERIES  # noqa: E402
from forumlens.session import build_session  # noqa: E402

HEADLINE = [
    "stg_questions", "stg_answers", "stg_users", "dim_user", "dim_tag", "fact_questions", "fact_answers",
    "fact_user_activity", "dq_report", "mart_tag_growth", "mart_trending_technologies",
    "mart_unanswered_questions", "mart_top_contributors", "mart_contributor_retention",
    "mart_answer_latency", "mart_answer_latency_approx", "mart_community_health",
    "kpi_01_platform_overview", "merge_raw_questions", "merge_stg_questions", "scd1_dim_user",
    "merge_fact_questions", "distributed_rank", "mart_top_contributors_distributed",
]
ONCE = ["full_rebuild", "run_incremental", "stream_upsert"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.warehouse.dir": os.environ.get("BENCH_WAREHOUSE", "/tmp/forumlens-bench-warehouse")})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in HEADLINE + ONCE:
        runs = [timed(name) for _ in range(1 if name in ONCE else 2)]
        seconds[name] = round(min(runs), 3)
        print(f"{name:36s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
