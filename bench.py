"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``, fully materialised through the no-op sink, and prints
one JSON line: ``{"metric", "value", "unit", "queries", "sf", ...}``.  Each
query is timed ``$BENCH_RUNS`` times (default 5) after one warm-up pass; the
median is reported and ``value`` is the sum of the medians.  Set
``$BENCH_EVENT_LOG`` to a folder to keep Spark's event log (stage and task
times) for the run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "tweet_shape", "stream_tweet_shape", "keyword_route", "term_frequency", "idf_weights",
    "tfidf_terms", "nb_parameters", "nb_predictions", "lr_accuracy",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from chirpflow.operators.models import FIT_SETTING
    from chirpflow.plans.queries import QUERIES
    from chirpflow.session import clear_scratch, get_session
    from chirpflow.sources.files import SPREAD_SETTING

    conf = {"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
            SPREAD_SETTING: cpus,  # the bench tables are one row group each, which one task would read
            FIT_SETTING: "2",  # 3,184 training rows with 111,174 terms: a task's gradient outweighs its rows
            "spark.driver.memory": os.environ.get("BENCH_MEM", "16g")}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times without the UI
        conf.update({"spark.eventLog.enabled": "true",
                     "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = get_session(master=f"local[{cpus}]", app_name="chirpflow-bench", log_level="ERROR",
                        conf=conf)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("tweet_shape")  # JVM / code-cache warm-up
    timings = {}
    for name in names:
        samples = [run(name) for _ in range(runs)]
        timings[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
        "spark": spark.version,
    }))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
