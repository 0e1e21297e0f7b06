"""

* shuffle bytes written per query (from Spark's event log, written to a
  scratch folder of this run);
* partition-count invariance: every registered query gives the same rows
  with 1 and with 64 shuffle partitions.

Usage: python tools/measure.py shuffle <sf_dir> key [key ...]
       python tools/measure.py invariance <sf_dir>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.registry import era_model, registry, retail_model  # noqa: E402
from quarry.session import get_session  # noqa: E402


def _events(path):
    import zstandard
    for f in sorted(glob.glob(os.path.join(path, "*", "events_*"))):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def shuffle(sf_dir, keys):
    log = tempfile.mkdtemp(prefix="quarry-ev-")
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log})
    era_model(spark, sf_dir), retail_model(spark, sf_dir)
    q = registry()
    marks = {}
    for k in keys:
        spark.sparkContext.setJobGroup(k, k)
        q[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    job_group, stage_key = {}, {}
    out = {k: {"shuffle_write_bytes": 0, "shuffle_records": 0, "stages": 0} for k in keys}
    for e in _events(log):
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e["Stage IDs"]:
                stage_key[sid] = g
        if e["Event"] == "SparkListenerTaskEnd":
            g = stage_key.get(e["Stage ID"])
            if g in out:
                wm = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                out[g]["shuffle_write_bytes"] += wm.get("Shuffle Bytes Written", 0)
                out[g]["shuffle_records"] += wm.get("Shuffle Records Written", 0)
        if e["Event"] == "SparkListenerStageCompleted":
            g = stage_key.get(e["Stage Info"]["Stage ID"])
            if g in out:
                out[g]["stages"] += 1
    del marks
    print(json.dumps(out))


def invariance(sf_dir):
    spark = get_session("local[8]", shuffle_partitions=8)
    q = registry()
    bad = []
    for k, fn in q.items():
        res = []
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = fn(spark, sf_dir)
            cols = sorted(df.columns)
            res.append(sorted(tuple(str(r[c]) for c in cols) for r in df.collect()))
        if res[0] != res[1]:
            bad.append(k)
    print(json.dumps({"queries": len(q), "differ": bad}))


if __name__ == "__main__":
    if sys.argv[1] == "shuffle":
        shuffle(sys.argv[2], sys.argv[3:])
    else:
        invariance(sys.argv[2])
