"""Time the headline queries and print one line of JSON.

    BENCH_SF_DIR   tables to use (default /root/testdata/sf0.1)
    BENCH_CPUS     cores (default 8)

Every query is run to the end into a sink that keeps nothing.  With
``--baseline`` the job is also timed as row-at-a-time Python functions, which is
how such jobs are commonly written.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame

from suite.baseline import cooccur_daily_in_python
from suite.compare import session
from suite.queries import QUERIES

HEADLINE = (
    "cooccurrence",
    "cooccur_daily",
    "cooccur_overall",
    "cooccur_sorted",
    "cooccurrence_many_topics",
    "cooccurrence_joined",
    "saturating_words",
    "preprocess_default",
    "expand_contractions",
    "replace_phrases",
    "tokens_multilang",
    "token_filter",
    "token_map",
    "token_map_joined",
    "stopword_anti",
    "norm_twitter",
    "join_source_meta",
    "dedupe_by_id",
    "series_pivot",
    "series_gapfill",
    "series_tumbling5",
    "series_rollup",
)


def seconds(make, runs: int = 1) -> float:
    best = float("inf")
    for _ in range(runs):
        started = time.time()
        frame: DataFrame = make()
        frame.write.format("noop").mode("overwrite").save()
        best = min(best, time.time() - started)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    warm_up = os.environ.get("BENCH_WARM_UP_DIR", sf_dir)
    seconds(lambda: QUERIES["cooccur_daily"](spark, warm_up))

    wanted = [a for a in sys.argv[1:] if not a.startswith("--")] or HEADLINE
    times = {name: seconds(lambda n=name: QUERIES[n](spark, sf_dir)) for name in wanted}
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rsplit("sf", 1)[-1].strip("/"),
        "cpus": int(cpus),
    }
    if "--baseline" in sys.argv:
        result["python_functions"] = {
            "cooccur_daily": seconds(lambda: cooccur_daily_in_python(spark, sf_dir))
        }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
