"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
Indexes are built once, timed as `index_lexical`, `index_vectors` and `index_ranks`, and read from storage by the searches;
judgments that the evaluation reads are stored once, timed as `stored_judgments`.
The given tables are one row group each, which Spark reads in one task; they are first written again in a file per
core, timed as `spread_tables`. Every query is run to a no-op sink, so all of its columns and rows are computed. A small index and
search on the least data set, where there is one, warm the engine first.
"""

from __future__ import annotations

import json
import os
import time

from checks import queries as q
from checks.session import session
from matchlake.operators.common import scratch_dir

HEADLINE = ["clean_documents", "dedup_documents", "strip_html_pages", "search_lexical", "search_term_cap",
            "search_long_queries", "score_pairs", "search_vectors", "search_hybrid", "match_jobs", "sample_topup",
            "candidates_random", "candidates_looked_up", "judgments_category", "judgments_pooled", "eval_per_query", "length_histogram",
            "top_terms"]


TABLES = ["documents", "pages", "benchmark", "conversations", "embeddings"]


def spread(spark, sf: str) -> str:
    """A folder with the tables that the headline queries read, in a file per core."""
    folder = scratch_dir(spark, "bench")
    for t in TABLES:
        spark.read.parquet(f"{sf}/{t}.parquet").repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{folder}/{t}.parquet")
    return folder


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    least = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(least):
        q.match_jobs(spark, least).collect()
    seconds = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    given, folders = sf, []
    timed("spread_tables", lambda: folders.append(spread(spark, sf)))
    sf = folders[0]
    timed("index_lexical", lambda: q.saved_lexical(spark, sf))
    timed("index_vectors", lambda: q.saved_vectors(spark, sf))
    q.picked_queries(spark, sf)
    timed("index_ranks", lambda: q.saved_ranks(spark, sf))
    timed("stored_judgments", lambda: q._pooled(spark, sf))  # an input of eval_per_query
    for name in HEADLINE:
        timed(name, lambda: q.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "total wall time of headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(given.rstrip("/"))}))


if __name__ == "__main__":
    main()
