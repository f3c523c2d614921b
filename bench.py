"""Time the headline queries on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_users",
    "silver_items",
    "gold_interactions",
    "gold_user_360",
    "user_features",
    "item_features",
    "training_set",
    "seed_item",
    "diversity_rerank",
    "dedupe_by_key",
    "q_completion_by_genre",
    "q_engagement_by_age",
    "q_top_shows_week",
    "q_recommended_share",
    "q_week_over_week",
    "cube_engagement",
    "upsert_by_key",
    "change_feed",
    "scd2_from_cdc",
    "profile_daily",
    "drift_numeric",
    "drift_categorical",
    "auc",
    "pii_scan",
    "knn_exact",
    "stream_equals_batch",
    "retrieve_factors",
    "recommend_batch",
    "factor_embeddings",
    "text_embedding",
    "knn_approx",
    "stream_upsert",
    "scd2_stream",
    "index_sync",
    "knn_quantised",
    "mmr_rerank",
    "champion_decision",
    "stream_dedupe_ordered",
    "profile_daily_sketch",
    "curve_layout",
    "quality_log",
    "ranker_search",
    "ranker_fit",
    "score_candidates",
    "recommend_chain",
]


def main() -> None:
    from reelgrove import build_session
    from reelgrove.session import job_scope
    from reelgrove.plans import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    times = {}
    for name in names:
        start = time.perf_counter()
        with job_scope(spark):
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
