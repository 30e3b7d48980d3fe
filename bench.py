"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``queries`` are seconds for the library's plans: the median of $BENCH_RUNS timed runs after a warm-up.
With BENCH_PLAIN=1 the direct shape of each query runs as well (the time joins take minutes in that
shape): ``plain_shape`` has its seconds, ``same_result`` whether both gave the same rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.plain_shapes import SHAPES  # noqa: E402
from checks.queries import BUILDERS, Inputs, as_checkable  # noqa: E402

EXTRA = ["eod_balances", "customer_dim", "scd2_changes"]


def fingerprint(df: DataFrame) -> tuple:
    shown = as_checkable(df)
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(shown.columns)])
    return tuple(shown.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)"))).first())


def timed(build, runs: int) -> float:
    seconds = []
    for _ in range(runs):
        began = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - began)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_ONLY", "")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs = Inputs(spark, sf_dir)
    ours, plain, same = {}, {}, {}
    with_plain = os.environ.get("BENCH_PLAIN", "0") == "1"
    for name in chosen.split(",") if chosen else [*SHAPES, *EXTRA]:
        first = fingerprint(BUILDERS[name](inputs))
        ours[name] = timed(lambda: BUILDERS[name](inputs), runs)
        if with_plain and name in SHAPES:
            same[name] = first == fingerprint(SHAPES[name](inputs))
            plain[name] = timed(lambda: SHAPES[name](inputs), runs)
        print(name, ours[name], plain.get(name), same.get(name), file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(ours.values()), 3),
                "unit": "sec",
                "queries": ours,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "plain_shape": plain,
                "same_result": same,
            }
        )
    )


if __name__ == "__main__":
    main()
