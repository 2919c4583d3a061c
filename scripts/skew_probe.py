"""Rows per task of a window over a hot key: plain window against the segmented scan.

One show is given a third of all episodes (sf0.1 line items as episodes, one season).
For each kind of order column the script prints the largest share of the hot show's rows
that one task sorts: all of them for a plain LAG window partitioned by (show, season),
the largest chunk for ``segmented_scan``; and the seconds of both, and of the plain
window and the scan over the shows as they are, where no key is hot.
Usage: python scripts/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tierflow.operators import scans  # noqa: E402
from tierflow.plans import adapters as A  # noqa: E402
from tierflow.session import build_session  # noqa: E402

KEYS = ["show_id", "season"]
LIMIT = 20_000
ORDERS = {
    "sparse": "episode_number * 1000003",
    "dense": "episode_number % 100",
    "tied": "1",
    "null": "cast(null as long)",
}


def seconds(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=64)
    base = A.volume_episodes(spark, sf_dir).select("show_id", F.lit(1).alias("season"), "episode_number", "episode_id", "l_partkey", "episode_rating")
    rest = ["episode_number", "episode_id", "l_partkey"]

    def forms(df, limit):
        w = Window.partitionBy(*KEYS).orderBy("o", *rest)
        plain = df.withColumns({"prev": F.lag("episode_rating").over(w), "next": F.lead("episode_rating").over(w)})
        return plain, lambda: scans.segmented_scan(df, KEYS, ["o", *rest], neighbours={"episode_rating": ("prev", "next")}, rows_per_chunk=limit)

    even = base.withColumn("o", F.col("episode_number"))
    plain, scan = forms(even, scans.ROWS_PER_CHUNK)
    times = [(seconds(plain), seconds_of_built(scan)) for _ in range(6)][1:]
    print(f"no hot key: plain window {min(t[0] for t in times):.2f} s, segmented scan {min(t[1] for t in times):.2f} s (best of 5)")
    hot = base.withColumn("show_id", F.when(F.col("episode_number") % 3 == 0, F.lit(0)).otherwise(F.col("show_id")))
    for kind, order in ORDERS.items():
        df = hot.withColumn("o", F.expr(order))
        parts = scans.split_hot(df, KEYS, LIMIT)
        chunks = scans.chunked(parts.hot, KEYS, [scans.ordered(c) for c in ["o", *rest]], math.ceil(parts.hot_rows / LIMIT))
        largest = chunks.groupBy(scans._CHUNK).count().agg(F.max("count")).first()[0]
        plain, scan = forms(df, LIMIT)
        print(f"{kind:10s}: hot rows {parts.hot_rows:,}; largest task {parts.hot_rows:,} plain, {largest:,} in chunks of {LIMIT:,}; {seconds(plain):.2f} s, {seconds_of_built(scan):.2f} s")


def seconds_of_built(build) -> float:
    """Building a scan runs jobs of its own (counts, chunks): they are part of its time."""
    start = time.perf_counter()
    seconds(build())
    return time.perf_counter() - start


if __name__ == "__main__":
    main()
