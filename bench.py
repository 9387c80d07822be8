"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is planned anew and all its columns are consumed by the no-op sink.
A first run on the smallest tables warms the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import time

from tastegrid.plans.catalog import QUERIES
from tastegrid.session import build_session

HEADLINE = (
    "item_avg_rating",
    "top_items_ranked",
    "dataset_profile",
    "favourite_genre_active",
    "genre_item_stats",
    "unrated_candidates",
    "recommend_top5",
    "exclude_bottom5",
    "cohort_top_items_low_balance",
    "rating_histogram30",
    "genre_top6_other",
    "rating_matrix_map",
    "profile_lookup",
    "keyed_table_upsert",
    "kfold_split",
    "holdout_first10",
    "holdout_capped",
    "scan_ratings_tsv",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "tastegrid-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            timed(spark, name, warm_dir)
    queries = {name: timed(spark, name, sf_dir) for name in HEADLINE}
    result = {
        "metric": "total_query_time",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
