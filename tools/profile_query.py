"""Time one catalogue query job by job from Spark's event log (written to a scratch dir).

    python tools/profile_query.py NAME [sf_dir]
    python tools/profile_query.py pipeline:build_star|pipeline:<mart name>|pipeline:dq_report

Runs the query twice through the noop sink and prints, for the second (warm) run, every
Spark job with its start offset, duration and stage count.  The UI stays off.
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, ".")
from fulcrum.plans.catalog import QUERIES  # noqa: E402


def main():
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.dir", logdir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    def run():
        if name.startswith("pipeline:"):
            from fulcrum.plans.build import Pipeline
            from fulcrum.sources.testdata import from_driver_tables

            p = Pipeline(from_driver_tables(spark, sf))
            step = name.split(":", 1)[1]
            if step != "build_star":
                df = p.quality_report() if step == "dq_report" else p.marts()[step]()
                df.write.format("noop").mode("overwrite").save()
        else:
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()

    run()
    t0 = time.time()
    run()
    print(f"{name}: warm wall {time.time() - t0:.3f}s")
    warm_start_ms = int(t0 * 1000)
    spark.stop()
    jobs = {}
    stages = {}
    for f in glob.glob(logdir + "/*"):
        for line in open(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"], props.get("spark.jobGroup.id")]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Submission Time" in si:
                    stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"], si["Number of Tasks"])
    warm = [j for j in sorted(jobs) if jobs[j][0] >= warm_start_ms]
    base = jobs[warm[0]][0]
    for j in warm:
        s, e, sids, _ = jobs[j]
        ran = [f"{sid}:{stages[sid][0]}ms/{stages[sid][1]}t" for sid in sids if sid in stages]
        print(f"job {j:4d} +{s - base:5d}ms dur {e - s:5d}ms stages {' '.join(ran)}")


if __name__ == "__main__":
    main()
