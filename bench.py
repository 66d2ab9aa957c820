"""Times the headline queries: one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the cores."""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.abspath(__file__)))

from vellumq.plans import registry  # noqa: E402
from vellumq.session import session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = ("token_coverage", "variant_spellings", "containment", "drift_ops", "budget_top", "line_pairs", "components", "doubled_words", "looped_docs", "kwic", "page_blocks", "hash_sample", "dictionary_reading")


def main() -> None:
    spark = session(f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    times = {}
    for name in names:
        best = None
        for _ in range(2):  # the first run also compiles
            began = time.perf_counter()
            registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
