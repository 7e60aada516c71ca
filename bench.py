"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Every
result is computed in full and thrown away by Spark's noop sink. The index that
the retrieval and codec queries share is built first and timed on its own.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame

from lexipost.plans.workload import QUERIES, index_of
from lexipost.session import local_session

HEADLINE = [
    "tokenize",
    "doc_dictionary",
    "lexicon",
    "postings",
    "build_index",
    "merge_segments",
    "index_extend",
    "index_scan",
    "postings_lookup",
    "retrieve",
    "retrieve_by_division",
    "retrieve_rarest_first",
    "retrieve_by_scan",
    "retrieve_items",
    "retrieve_items_joined",
    "validate_results",
    "gaps",
    "encode_raw",
    "encode_vb",
    "encode_gamma",
    "decode_raw",
    "decode_vb",
    "decode_gamma",
    "term_stats",
    "index_size_report",
    "codec_roundtrip",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    timed("shared_index", lambda: index_of(spark, sf_dir))
    for codec in ("raw", "vb", "gamma"):
        if f"decode_{codec}" in names:
            timed(f"shared_index_{codec}", lambda codec=codec: index_of(spark, sf_dir, codec))
    for name in names:
        timed(name, lambda name=name: run(QUERIES[name](spark, sf_dir)))
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
