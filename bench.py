"""Time the headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kestrel.plans import HEADLINE, REGISTRY  # noqa: E402
from kestrel.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app_name="kestrel-bench")
    # warm-up: JVM start, class loading, first parquet footer reads
    REGISTRY["trip_peak_weekend_summary"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        df = REGISTRY[name][0](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # full execution, nothing collected
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
