"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the no-op sink (every row and column is
computed, nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trustlens.plans.queries import QUERIES  # noqa: E402
from trustlens.session import get_spark  # noqa: E402

HEADLINE = [
    "label_reviews",          # A8-A10, B1-B3, E13-E15, F1-F7: the labeller
    "label_distribution",     # flagship
    "text_quality",           # D1-D14 on every whole document
    "preprocess_reviews",     # C1-C15
    "tfidf",                  # I1-I5
    "nb_predict",             # I7, I8, J1-J6 (fit + score)
    "undersample_orders",     # H1, H2 on orders
    "balance_comparison",     # H1-H5
    "split_stratified",       # H10
    "best_split",             # J15 on embeddings
    "svm_loss_grad",          # J7
    "same_day_events",        # E15 on events
    "nb_scoring",             # K1, K4, K6: fit on given labels, score every review
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
