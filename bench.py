"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vouchwell.plans import catalog  # noqa: E402
from vouchwell.session import local_session  # noqa: E402

HEADLINE = [
    "stg_invoices",
    "invoice_features",
    "benford_flags",
    "threshold_flags",
    "shell_vendor_flags",
    "duplicate_pairs",
    "duplicate_flags",
    "rule_vote",
    "eval_metrics",
    "dq_report",
    "amount_profile",
    "encoded_numeric",
    "encoded_onehot",
    "score_labels",
    "iforest_predictions",
    "iforest_sweep",
    "mart_after_append",
    "wide_autoencoder_predictions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "vouchwell-bench", shuffle_partitions=int(cores))
    queries = catalog.queries()
    # One small query loads classes and compiles common code before timing starts.
    queries["shell_vendor_flags"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
