"""Times the headline queries and prints one JSON line.

Each query is warmed up at the smallest scale, then run once over the whole tables
with every result row produced; the row count goes with the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rentscope.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "district_metrics", "recommendations", "batch_quotes", "quote_breakdown", "clean_rent",
    "district_summary", "transactions_summary", "market_segments", "segment_assignments",
    "post_tags", "post_prices", "redacted_posts", "newest_articles", "kept_signals", "top_tags",
    "forum_summary", "review_summary", "page_text", "price_records", "price_report",
    "interest_stats", "evidence_report",
]


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds, rows = {}, {}
    for name in names:
        produce(QUERIES[name](spark, os.path.join(os.path.dirname(SF_DIR), "sf0.001")))
        start = time.perf_counter()
        rows[name] = produce(QUERIES[name](spark, SF_DIR))
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]} s, {rows[name]} rows", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


def produce(df) -> int:
    """Compute every column of every row; the hash keeps any from being pruned."""
    return df.agg(F.count(F.lit(1)), F.max(F.xxhash64(*df.columns))).first()[0]


if __name__ == "__main__":
    main()
