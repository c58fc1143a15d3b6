"""

Usage: python tools/baseline.py [sf_dir] [reps]
Both sides of a query are timed alternately in one run, so that load and
machine speed meet both alike. Deriving the analog views is timed for itself:
it is done once for all queries on Spark and within each query on DuckDB.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, ".")

from shelfaudit.catalog.codes import TEST_CODES  # noqa: E402
from shelfaudit.catalog.forms import QUERIES  # noqa: E402
from shelfaudit.catalog.oracle import SQL  # noqa: E402
from shelfaudit.session import local_session  # noqa: E402
from shelfaudit.sources import analog  # noqa: E402
from tools.compare import duck  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    reps = int(argv[2]) if len(argv) > 2 else 3
    spark, con = local_session(8), duck(sf_dir)
    t = time.time()
    analog.tables(spark, sf_dir, TEST_CODES)
    print(f"prepare_sec {time.time() - t:.3f}, {os.cpu_count()} CPUs, load {os.getloadavg()[0]:.1f} at the start\n")
    print("| query | rows | Spark sec | DuckDB sec | ratio | load |\n| --- | --- | --- | --- | --- | --- |")
    total = [0.0, 0.0]
    for name, fn in QUERIES.items():
        rows = fn(spark, sf_dir).count()  # warm
        times: tuple[list, list] = ([], [])
        for _ in range(reps):
            t = time.time()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[0].append(time.time() - t)
            t = time.time()
            con.execute(SQL[name]).fetchall()
            times[1].append(time.time() - t)
        a, b = map(statistics.median, times)
        total = [total[0] + a, total[1] + b]
        print(f"| {name} | {rows} | {a:.3f} | {b:.3f} | {a / b:.1f} | {os.getloadavg()[0]:.1f} |", flush=True)
    print(f"| **total** | | **{total[0]:.3f}** | **{total[1]:.3f}** | {total[0] / total[1]:.1f} | |")


if __name__ == "__main__":
    main(sys.argv)
