"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Every query runs twice
from scratch, landing copies and stored intermediates included; the better run counts.
"""

from __future__ import annotations

import json
import os
import time

from daygrain.session import build_session, temporary
from proofs.queries import REGISTRY

HEADLINE = [
    "gold_weather",
    "gold_crime",
    "gold_games",
    "city_days",
    "city_correlations",
    "j2_full_outer_three_keys",
    "p6_pick_by_side_j3_either_team",
    "w2_game_numbers",
    "w4_signed_streaks_w5_w6_w7_running_records",
    "w8_day_norms",
    "w9_carried_forward",
    "w10_last_row_per_day",
    "a8_means_by_weather",
    "a10_correlation_matrix",
    "a12_linear_fit",
    "q1_duplicate_keys",
    "s14_time_range",
    "s15_upsert",
    "s19_recompile_year",
    "t1_landing_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            with temporary(spark):
                began = time.perf_counter()
                REGISTRY[name][0](spark, folder).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - began)
        seconds[name] = round(min(runs), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
