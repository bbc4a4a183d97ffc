"""Stage times of the flagship and of two exact-ALS epochs, from Spark's event log.

usage: python tools/stage_times.py [sf_dir] > STAGES.md
The event log goes to a fresh folder under /tmp (no UI, no server).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratewise import build_session  # noqa: E402
from ratewise.operators.als_exact import als_exact  # noqa: E402
from ratewise.plans import catalog as C  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        8, 16, extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
        },
    )
    marks = []

    def job(name, fn):
        spark.sparkContext.setJobGroup(name, name)
        t = time.time()
        fn()
        marks.append((name, round(time.time() - t, 2)))

    warm = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        w_train, w_test = C._train_test(spark, warm)
        job("warm-up", lambda: (
            C.q_publish_recs(spark, warm).write.format("noop").mode("overwrite").save(),
            als_exact(spark, w_train, rank=5, n_iter=1, test=w_test),
        ))
    job("flagship publish_recs", lambda: C.q_publish_recs(spark, sf).write.format("noop").mode("overwrite").save())
    train, test = C._train_test(spark, sf)
    job("exact ALS rank 5, 2 epochs", lambda: als_exact(spark, train, rank=5, n_iter=2, test=test))
    spark.stop()

    stages = []
    group_of = {}
    # Spark 4 writes rolling logs: one folder per application, event files inside.
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or not os.path.basename(path).startswith(("events", "local")):
            continue
        with open(path) as fh:
            for line in fh:
                if not line.startswith("{"):
                    continue
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        group_of[sid] = grp
                    continue
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                rdds = [r.get("Name", "").splitlines()[0] if r.get("Name") else "" for r in info.get("RDD Info", [])]
                label = ", ".join(n for n in rdds if n and not n.startswith(("MapPartitionsRDD", "ShuffledRowRDD", "FileScanRDD", "SQLExecutionRDD", "AdaptiveSparkPlan", "*")))[:90]
                if "Submission Time" not in info or "Completion Time" not in info:
                    continue
                stages.append(
                    (
                        info["Completion Time"] - info["Submission Time"],
                        info["Stage ID"],
                        info["Number of Tasks"],
                        label or info["Stage Name"].split(" at ")[0],
                    )
                )
    print(f"# Stage times (sf = {os.path.basename(sf.rstrip('/'))}, local[8], event log)\n")
    print("| job | wall s |\n| --- | --- |")
    for name, sec in marks:
        print(f"| {name} | {sec} |")
    stages = [st for st in stages if group_of.get(st[1]) != "warm-up"]
    print(f"\n{len(stages)} stages after the warm-up, {sum(st[0] for st in stages) / 1000:.1f} s summed."
          " Slowest 20:\n")
    print("| job group | stage | tasks | ms | RDDs / name |\n| --- | --- | --- | --- | --- |")
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:20]:
        print(f"| {group_of.get(sid, '')} | {sid} | {tasks} | {ms} | {name} |")


if __name__ == "__main__":
    main()
