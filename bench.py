"""Time the headline queries; prints one JSON line.

The laid-out step tables are built once and timed as `prepare`; every query then writes all of its rows
to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from setstride.plans import QUERIES  # noqa: E402
from setstride.plans.common import draws, numbered_events  # noqa: E402
from setstride.session import local_session  # noqa: E402

HEADLINE = [
    "frequency_picks",
    "markov_picks",
    "bayesian_picks",
    "walk_metrics",
    "fold_metrics",
    "prequential_metrics",
    "multi_ticket_returns",
    "stale_predictions",
    "drift_all_steps",
    "rolling_counts",
    "feature_correlations",
    "feature_matrix",
    "item_gap_stats",
    "event_gap_stats",
    "cooccurrence",
    "brand_cooccurrence",
    "transition_matrix",
    "item_auc",
    "best_combinations",
    "neighbour_votes",
    "next_step_picks",
    "perceptron_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    start = time.time()
    table = draws(spark, folder)
    numbered_events(spark, folder)
    times = {"prepare": round(time.time() - start, 3)}
    for name in wanted:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    rates = {
        name: round(table.longest / times[name], 1) for name in ("frequency_picks", "markov_picks", "bayesian_picks") if name in times
    }
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
             "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "steps": table.longest, "steps_per_sec": rates}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
