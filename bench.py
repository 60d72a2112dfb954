"""Times the headline queries on one machine and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linksift.plans.catalog import QUERIES  # noqa: E402
from linksift.plans.fixtures import feature_table, forest  # noqa: E402
from linksift.session import local_session  # noqa: E402

HEADLINE = (
    "url_features", "brand_distance", "brand_jaro_winkler", "url_tokens", "char_entropy", "rule_hits",
    "reason_sums", "top_risk", "scan_linear", "export_csv", "stix_indicators", "distinct_score",
    "hourly_verdicts", "unseen_urls", "point_metrics", "threshold_scan", "roc_curve", "bootstrap_ci",
    "conformal_fit", "psi_drift", "drift_report", "ngram_counts", "mutated_urls", "online_update",
    "train_lr", "train_rf", "scan_batch", "tree_contributions", "watch_scan",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "linksift-bench", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM threads and Python workers before the clock runs
    QUERIES["top_risk"](spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")).collect()
    times = {}
    # tables that several queries share are made first, each on a line of its own
    for name, make in (("prepare_features", feature_table), ("prepare_forest", forest)):
        start = time.perf_counter()
        make(spark, sf_dir)
        times[name] = round(time.perf_counter() - start, 3)
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    for name in chosen:
        start = time.perf_counter()
        # every row and column is worked out, nothing is collected
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
