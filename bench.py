"""Headline timings: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; the median is reported after one warm-up run).
Each query is executed in full with a no-op sink (``format("noop")``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curvethin.plans import catalog as C  # noqa: E402
from curvethin.session import checkpoint_dir, local_session  # noqa: E402

HEADLINE = {
    "thin_series": C.q_thin_series,                  # B: many ~66-row series
    "thin_series_by_type": C.q_thin_series_by_type,  # C: 5 long series
    "thin_all_metrics": C.q_thin_all_metrics,        # A: 5 metrics per row
    "compressed_output": C.q_compressed_output,      # A: + join back to wide rows
    "chosen_level": C.q_chosen_level,                # B: per-series fit report
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="curvethin-bench")
    checkpoint_dir(spark)
    times: dict[str, float] = {}
    for name in names:
        fn = HEADLINE[name]
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            if i:  # first run warms the JVM / code caches
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
