"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the no-op sink (the whole plan runs, nothing
is collected); one warm-up run, then the median of $BENCH_REPEATS timed runs.  Prints ONE
JSON line: {"metric", "value" (sum of medians), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship",
    "io4_split",
    "pr4_describe",
    "pr7_corr_matrix",
    "od1_iqr_lineitem",
    "od2_mad_lineitem",
    "mv1_median",
    "mv3_group",
    "fe3_group_stats",
    "fe4_cat_pairs",
    "cd4_combined",
    "ct2_mode",
    "en1_label",
    "en4_target",
    "fs3_mi_binned",
    "mt2_auc",
    "od3_knn",
    "mv2_knn",
    "ib3_tomek",
    "ib5_smote",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from tessera.plans.catalog import QUERIES
    from tessera.plans.flagship import flagship
    from tessera.session import build_session

    spark = build_session(cpus, extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    qs = dict(QUERIES)
    qs["flagship"] = flagship
    names = only or HEADLINE
    out = {}
    for name in names:
        fn = qs[name]

        def run():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        try:
            run()  # warm-up
            times = [run() for _ in range(repeats)]
            out[name] = round(statistics.median(times), 3)
        except Exception as e:  # noqa: BLE001 - a failing query is reported, not hidden
            out[name] = None
            print(f"bench: {name} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
    total = round(sum(v for v in out.values() if v is not None), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus, "repeats": repeats,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
