"""Time the load and every report at ``$BENCH_SF_DIR``; prints one JSON line.

First the test tables are brought into the flat shape of an order file (``prepare``: the
baseline starts from such a file, so this is timed but not part of the headline). The load writes
the stored tables and every report then runs to its last row. The groups follow the phases of
"""

import json
import os
import sys
import tempfile
import time

from orderlens.plans import catalog, marts
from orderlens.plans.inputs import Inputs
from orderlens.session import local_session
from orderlens.sources.files import read_mart, write_mart

PHASES = ["profile", "sales", "customers", "kpi", "advanced"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    store = tempfile.mkdtemp(prefix="orderlens-bench-")
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.time()
        work()
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    timed("prepare", lambda: write_mart(Inputs(spark, folder).raw, store, marts.RAW))
    phases = {"prepare": times["prepare"]}
    raw = read_mart(spark, store, marts.RAW)
    timed("load_star", lambda: marts.build_star(raw, store))
    timed("load_lines", lambda: marts.build_line_marts(raw, store))
    timed("load_sketches", lambda: marts.build_sketches(read_mart(spark, store, marts.SALES), store))
    timed(
        "load_customers",
        lambda: marts.build_customer_marts(read_mart(spark, store, marts.SALES), store),
    )
    phases["load"] = round(sum(times.values()) - times["prepare"], 3)
    inputs = marts.StoredInputs(spark, folder, store)
    for phase in [*PHASES, "star", "dashboard", "measures"]:
        before = sum(times.values())
        for name, query in catalog.GROUPS[phase].items():
            timed(name, lambda: run(query(inputs)))
        phases[phase] = round(sum(times.values()) - before, 3)

    print(
        json.dumps(
            {
                "metric": "load and the five report phases of the baseline",
                "value": round(sum(phases[p] for p in ["load", *PHASES]), 3),
                "unit": "sec",
                "queries": times,
                "phases": phases,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
