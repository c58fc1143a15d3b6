"""Benchmark: run every catalogue query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is timed from building its DataFrame
(staging writes included) to a full evaluation through the ``noop`` sink,
median of $BENCH_REPS runs after $BENCH_WARMUP untimed passes over all
queries (warm JVM). Deriving the analog input views from the test
tables (the stand-ins for base tables) is timed once as ``prepare_sec``
and not counted in the query times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfaudit.catalog.codes import TEST_CODES  # noqa: E402
from shelfaudit.catalog.forms import QUERIES  # noqa: E402
from shelfaudit.session import local_session  # noqa: E402
from shelfaudit.sources import analog  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))

    t0 = time.time()
    analog.tables(spark, sf_dir, TEST_CODES)
    prepare = time.time() - t0

    warmup = int(os.environ.get("BENCH_WARMUP", "1"))
    errors: dict[str, str] = {}
    for _ in range(warmup):  # untimed pass: JIT and the first-job costs of every plan shape
        for name, fn in QUERIES.items():
            if not only or name in only:
                try:
                    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                except Exception as exc:  # recorded below, the run goes on
                    errors[name] = str(exc).splitlines()[0][:200]

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, fn in QUERIES.items():
        if (only and name not in only) or name in errors:
            continue
        try:
            runs = []
            for _ in range(reps):
                t = time.time()
                df = fn(spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
                runs.append(time.time() - t)
            times[name] = round(statistics.median(runs), 3)
            rows[name] = fn(spark, sf_dir).count()
        except Exception as exc:
            errors[name] = str(exc).splitlines()[0][:200]
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "catalogue_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "errors": errors,
        "prepare_sec": round(prepare, 3),
        "sf": sf,
        "cpus": cpus,
        "reps": reps,
        "warmup_passes": warmup,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
