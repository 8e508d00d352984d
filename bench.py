"""Benchmark: ETL build + headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is fully executed with the no-op sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["markov_long", "markov_counts", "markov_matrix", "fleet_by_group", "open_rentals",
            "reservation_demand", "top_groups", "src_city_groups", "insert_ignore_new", "surrogate_keys",
            "fato_locacao", "dq_discards", "dq_unique", "ext_a_locacao", "std_locacao"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from fleetdw.session import build_session

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(4, cpus)))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=shuffle, app="fleetdw-bench")
    spark.sparkContext.setLogLevel("ERROR")
    from fleetdw.plans.star import store_for
    from fleetdw.queries import registry

    timings: dict[str, float] = {}
    t0 = time.time()
    store_for(spark, sf_dir)  # the ETL: builds, writes and remembers the star store
    timings["etl_build"] = round(time.time() - t0, 3)
    qs = registry()
    for name in HEADLINE:
        t = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t, 3)
    total = round(sum(timings.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "etl_plus_headline_queries_wall", "value": total, "unit": "sec",
                      "queries": timings, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
                      "spark": spark.version, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}))
    spark.stop()


if __name__ == "__main__":
    main()
