"""Times the headline queries: one untimed run each (code generation, file cache), one timed.

Prints one JSON line. $BENCH_SF_DIR names the tables, $BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from tallyfold.plans.catalogue import REGISTRY
from tallyfold.session import local_session

HEADLINE = [
    "score_logit_expr", "assess_lift", "assess_roc", "assess_auc", "assess_all_by_part", "fair_group_metrics",
    "stats_corr", "stats_simple", "freq_oneway", "prep_standardize", "prep_dummies", "prep_woe", "prep_quantile_bin",
    "split_exact", "split_hash", "sample_kfold", "src_csv_roundtrip", "decision_flow", "explain_pd",
    "explain_shapley_exact", "monitor_psi", "ts_ar1_forecast", "text_mask_pii", "fuzzy_join", "train_logit_mle",
    "train_gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus=cpus, partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for timed in (False, True):
            started = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if timed:
                seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
