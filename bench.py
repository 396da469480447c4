"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Besides the warm median of each query it records how many Spark jobs a run starts and how many
bytes it shuffles, from Spark's event log in a scratch folder.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import validation
from tidemark.operators.validation import Rule
from tidemark.session import scratch
from tidemark.workload import registry, views

HEADLINE = [
    "job_ready_rollup",
    "ready_date_range",
    "ready_max_date",
    "catchup_expand",
    "range_or_set_scan",
    "guard_transform",
    "load_upsert",
    "load_upsert_partitioned",
    "load_partition",
    "validate_rules",
    "audit_fold",
    "workflow_complete",
    "composed_run",
]
_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def rules_on_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty rules on one table: one scan."""
    rules = [
        Rule(f"{name}_{column}", "lineitem", f"{name}({column})", (column,), 0.0, ">=")
        for name in validation.AGGREGATES for column in _COLUMNS
    ]
    return validation.evaluate(rules, {"lineitem": views.table(spark, sf_dir, "lineitem")})


def counted(folder: str) -> tuple[Counter, Counter]:
    """Jobs and shuffled bytes by job group, from the event log."""
    jobs, shuffled, group_of = Counter(), Counter(), {}
    for path in Path(folder).rglob("*"):
        for line in path.open() if path.is_file() else ():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = event.get("Properties", {}).get("spark.jobGroup.id")
                jobs[group] += 1
                group_of.update(dict.fromkeys(event["Stage IDs"], group))
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                written = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                shuffled[group_of.get(event["Stage ID"])] += written
    return jobs, shuffled


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    base = tempfile.mkdtemp(prefix="tidemark-bench-")
    Path(base, "events").mkdir()
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.checkpoint.dir", f"{base}/shared")  # one machine: its folder is shared
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{base}/events")
        .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = {n: registry.queries()[n] for n in HEADLINE} | {"rules_on_lineitem": rules_on_lineitem}, {}
    for name, query in queries.items():
        runs = []
        for i in range(repeats + 1):  # the first run warms up
            spark.sparkContext.setJobGroup(name if i == repeats else "other", name)
            with scratch(spark):
                start = time.perf_counter()
                query(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    jobs, shuffled = counted(f"{base}/events")
    print(json.dumps({
        "metric": "headline query time, median of warm runs", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
        "jobs": {n: jobs[n] for n in queries}, "shuffle_bytes": {n: shuffled[n] for n in queries},
    }))


if __name__ == "__main__":
    main()
