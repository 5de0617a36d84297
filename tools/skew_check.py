"""Measure task sizes of a per-class rank on a skewed class column.

Builds (from lineitem) a table where one class holds a third of the rows,
then ranks rows inside their class twice: with a plain per-class window and
with ``rank_within_groups`` (hash buckets). Reads Spark's event log (written
to a fresh scratch folder) and prints, per variant, the largest number of
shuffle records read by one task and the wall time.

usage: python tools/skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    copies = int(argv[2]) if len(argv) > 2 else 4
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    from pyspark.sql import SparkSession
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.sql.shuffle.partitions", "64").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.sql.adaptive.enabled", "false")  # fixed partitions: compare plans, not AQE
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from tessera.operators.sampling import hash_uniform, rank_within_groups
    from tessera.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)

    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    rows = li.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    rows = rows.select((F.col("l_orderkey") * 8 + F.col("l_linenumber") + F.col("copy") * (1 << 40)).alias("key"),
                       F.when(F.col("l_linenumber") <= 2, 0).otherwise(F.col("l_linenumber")).alias("label"))
    rows = rows.withColumn("u", hash_uniform(13, F.col("key")))
    total = rows.count()
    hot = rows.where("label = 0").count()
    print(f"rows {total}, hot class rows {hot} ({hot / total:.0%})")

    jobs = {}
    t0 = time.time()
    spark.sparkContext.setJobGroup("plain", "plain per-class window")
    w = Window.partitionBy("label").orderBy("u", "key")
    rows.withColumn("r", F.row_number().over(w)).write.format("noop").mode("overwrite").save()
    jobs["plain per-class window"] = time.time() - t0
    t0 = time.time()
    spark.sparkContext.setJobGroup("bucketed", "bucketed rank")
    rank_within_groups(rows, ["label"], "u", "key").write.format("noop").mode("overwrite").save()
    jobs["bucketed rank (rank_within_groups)"] = time.time() - t0
    spark.stop()

    # largest shuffle read (records) of one task, per job group
    group_of_stage, max_read = {}, {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for st in ev.get("Stage IDs", []):
                        group_of_stage[st] = grp
                elif kind == "SparkListenerTaskEnd":
                    grp = group_of_stage.get(ev["Stage ID"])
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    if grp:
                        max_read[grp] = max(max_read.get(grp, 0), recs)
    print(f"{'variant':40s} {'max records / task':>20s} {'seconds':>8s}")
    for (name, secs), grp in zip(jobs.items(), ["plain", "bucketed"]):
        print(f"{name:40s} {max_read.get(grp, 0):20d} {secs:8.1f}")
    print("event log:", log_dir)


if __name__ == "__main__":
    main(sys.argv)
