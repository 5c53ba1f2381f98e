"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from gristmill.plans import catalog
from gristmill.session import local_session

HEADLINE = ["text_scores", "funnel_documents", "funnel_stats", "exact_dup", "text_minhash", "html_articles", "window_statistics", "stuck_runs", "scd2_pit_join", "dws_day", "contract_checks", "cosine_topk", "psi_events"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "12g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/documents.parquet").selectExpr("sum(length(text))").collect()
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rstrip("/").rpartition("sf")[2]}))


if __name__ == "__main__":
    main()
