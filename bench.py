"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm the JVM and the Python workers and timed on the
run after it; the model fits come last, when both are warm, and run once. Results
are written to the no-op sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chirrup.plans.registry import registry  # noqa: E402
from chirrup.session import build_session  # noqa: E402

HEADLINE = (
    "h2_top_users_by_location", "e3_engagement_by_platform", "m1_engagement_by_location", "follower_deciles",
    "clean_posts", "dq_users_posts", "hourly_timeline", "flagged_events", "trigger_verdicts", "clean_text_docs",
    "relevance_split", "top_tokens_by_class", "char_ngram_top", "tfidf_weights", "group_split", "nb_sentiment",
)
FITS = ("batch_scoring", "lr_sentiment", "balanced_lr", "svm_sentiment", "union_features")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "chirrup-bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    all_queries, times = registry(), {}
    for name in (*HEADLINE, *FITS):
        for _ in range(1 if name in FITS else 2):
            t0 = time.time()
            all_queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
