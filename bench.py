"""Time the load and the reports; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_MEMORY (default 8g).
`pipeline` is a whole run with staging: extract, calendar, five dimensions, fact, checks. `reload`
runs it again on the loaded warehouse, where every order line is already present. The reports then
read the published tables; each result is computed in full.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from salesmill.operators.quality import orphans, repeated_keys
from salesmill.plans.headlines import HEADLINES
from salesmill.plans.kpis import KPIS
from salesmill.plans.pipeline import read_dims, read_fact, run_pipeline
from salesmill.schemas import FATO_VENDAS
from salesmill.session import local_session, scratch_path
from salesmill.sources.testdata import LINE_ORDER, TestTables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def main() -> None:
    spark = local_session(app="bench")
    times: dict[str, float] = {}

    def timed(name, step):
        start = time.perf_counter()
        result = step()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
        return result

    def computed(df):
        df.write.format("noop").mode("overwrite").save()

    source = TestTables(spark, FOLDER)
    root = scratch_path(spark, "bench")

    def load():
        return run_pipeline(spark, source, root, load_date="2024-01-01", order=LINE_ORDER)

    wh = timed("pipeline", load)
    timed("reload", load)
    fact, dims = read_fact(wh), read_dims(wh)
    for name, report in {**KPIS, **HEADLINES}.items():
        timed(name, lambda: computed(report(fact, dims)))
    timed("dq_unique", lambda: computed(repeated_keys(fact, "fato_vendas", FATO_VENDAS.natural)))
    timed(
        "dq_foreign_key_cliente",
        lambda: computed(orphans(fact, "fato_vendas", "sk_cliente", dims["dim_cliente"], "dim_cliente", "sk_cliente")),
    )
    rows = fact.count()
    print(json.dumps({
        "metric": "load, reload and reports",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(Path(FOLDER).name.removeprefix("sf")),
        "fact_rows": rows,
        "load_rows_per_sec": round(rows / times["pipeline"]),
        "cpus": spark.sparkContext.defaultParallelism,
        "memory": spark.conf.get("spark.driver.memory"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
