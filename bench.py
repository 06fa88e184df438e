"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query runs once to
warm up on the smallest tables beside it, if there are any, and is then timed
from building the plan to the last row, which a sink takes without keeping it.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from crivo.plans.queries import queries  # noqa: E402
from crivo.session import build_session  # noqa: E402

HEADLINES = (
    "scan_features",
    "gen_contracts",
    "one_hot",
    "align_signature",
    "stratified_split",
    "auc",
    "run_metrics",
    "promotion_decision",
    "registry_versions",
    "registry_aliases",
    "train_champion",
    "train_challenger",
    "score_batch",
    "predictions_table",
    "prediction_distribution",
    "score_sample",
    "trace_spans",
    "payload_write",
    "payload_lookup",
    "audit_join",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.sql.shuffle.partitions": cpus,
        # Tables this small would otherwise be gathered into fewer tasks than cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    }
    spark = build_session("bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    warm_up = Path(folder).parent / "sf0.001"
    registered, seconds = queries(), {}
    for name in HEADLINES:
        if warm_up.is_dir():
            run(registered[name](spark, str(warm_up)))
        start = time.perf_counter()
        run(registered[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line), flush=True)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


if __name__ == "__main__":
    main()
