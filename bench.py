"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from payspark.session import build_session  # noqa: E402
from payspark.verification.registry import queries  # noqa: E402

HEADLINE = (
    "annualized_wage", "salary_text_parsed", "merged_postings", "dedup_by_quality", "best_record_dedup", "salary_by_state",
    "percentile_table", "salary_histogram", "skill_coverage", "skill_cooccurrence", "feature_table", "stratified_split",
    "document_fields", "regression_metrics",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("payspark-bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    chosen = queries()
    chosen["annualized_wage"](spark, sf).limit(1).collect()  # start the JVM's code paths
    times = {}
    for name in HEADLINE:
        start = time.time()
        chosen[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
