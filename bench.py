"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores,
BENCH_QUERIES an optional comma-separated list of names or prefixes.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gaugework.queries import QUERIES  # noqa: E402
from gaugework.session import local_session  # noqa: E402

HEADLINE = (
    "k01_feature_snapshot k03_chronological_split k05_mtbf_by_model k08_observed_availability k11_asset_snapshot k20_part_usage "
    "k23_order_and_material_cost k28_sales_by_year_category d01_star_join d08_as_of_meter d10_failures_in_window d11_next_failure "
    "d13_interval_stab d16_interval_issues e01_tumbling_features e03_percentile e12_ratio_of_sums e17_federal_summary e17_state_summary "
    "e18_effective_rates f01_latest_row f07_neighbour_rows f08_cumulative_curve g03_capped_sample j07_ranking_metrics m03_outcome_summary "
    "n02_duplicate_composite_keys n06_ownership n12_federal_state_lineage p01_metric_by_region a08_merge_insert_only h03_insert_only_merge "
    "c10_unpivot_state_lines"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = [n for n in QUERIES if n.startswith(tuple(wanted))] if wanted else HEADLINE
    spark = local_session(cpus, "gaugework-bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before timing
    times: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
