"""How the plans scale: the same queries over k shifted copies of ``events``.

Not the driver's benchmark (that is ``bench.py``). For each k in
``SCALE_COPIES`` (default ``1,4,16``) it times, median of ``SCALE_RUNS``
runs after a warm-up, each plan executed into the ``noop`` sink, and prints
one JSON line per k with seconds and input rows per second. Inputs are
derived from the driver's tables (``fixtures.events(copies=k)``), so the
work grows with k.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    from meterlake.operators import grid, silver
    from meterlake.plans import drilldown, pipeline, queries
    from meterlake.session import build_session
    from meterlake.sources import fixtures as FX
    from meterlake.sources import lake

    sf_dir = os.environ.get("SCALE_SF_DIR", "/root/testdata/sf0.1")
    ks = [int(x) for x in os.environ.get("SCALE_COPIES", "1,4,16").split(",")]
    runs = int(os.environ.get("SCALE_RUNS", "3"))
    cpus = int(os.environ.get("SCALE_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="scale")
    base_rows = FX.table(spark, sf_dir, "events").count()

    def plans(k):
        return {
            "daily_totals": lambda: queries.daily_totals(FX.readings_gold(spark, sf_dir, k)),
            "peak_interval": lambda: queries.peak_interval(
                queries.meter_timeseries(FX.readings_gold(spark, sf_dir, k))),
            "peak_drilldown": lambda: drilldown.peak_drilldown(FX.readings_gold(spark, sf_dir, k)),
            "grid_records": lambda: grid.cells_to_bronze(FX.cells(spark, sf_dir, k)),
            "parse_timestamps": lambda: silver.to_silver(
                grid.cells_to_bronze(FX.cells(spark, sf_dir, k))),
            "pipeline_to_gold": None,
        }

    for k in ks:
        out = {}
        for name, mk in plans(k).items():
            times = []
            for i in range(runs + 1):
                t0 = time.perf_counter()
                if mk is None:
                    root = lake.scratch_root(spark, "scale")
                    pipeline.run(spark, FX.cells(spark, sf_dir, k), root)
                    drilldown.peak_drilldown(lake.read_gold(spark, root)) \
                        .write.format("noop").mode("overwrite").save()
                else:
                    mk().write.format("noop").mode("overwrite").save()
                if i:
                    times.append(time.perf_counter() - t0)
            sec = statistics.median(times)
            out[name] = {"sec": round(sec, 3), "events_per_sec": int(base_rows * k / sec)}
        print(json.dumps({"copies": k, "events": base_rows * k, "cpus": cpus, "queries": out}),
              flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
