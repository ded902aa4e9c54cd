"""Time the headline queries: BENCH_SF_DIR names the tables, BENCH_CPUS the cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ladewerk.plans.queries import QUERIES  # noqa: E402
from ladewerk.session import local_session  # noqa: E402

HEADLINE = [
    "gate_report", "gate_event_log", "score_rows", "score_json_text", "canonical_json",
    "validate_labels", "reference_guard", "trusted_export", "review_queue", "review_load_fraction",
    "label_audit", "synth_generate", "train_set", "retrain_set", "sft_rows", "extract_full",
    "extractor_gate", "extract_external", "gate_from_store",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.read.parquet(f"{folder}/nation.parquet").count()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        started = time.perf_counter()
        # Every row and column is computed; nothing is brought to the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
