"""Scale / skew check on generated data (not part of the test suite).

Usage: python tools/scale_check.py ROWS HOT_SHARE [CPUS]

Generates ROWS synthetic interactions (HOT_SHARE of them for one user),
writes them as Parquet under the shared scratch folder, then times the
bucket-based sessionization against the straight per-user window, and a
few other headline operators. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def timed(spark, name, fn):
    spark.sparkContext.setJobDescription(name)
    t0 = time.perf_counter()
    fn().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    return round(time.perf_counter() - t0, 2)


def largest_tasks(log_dir: str) -> dict:
    """Per job description: most records one task read (shuffle + scan)
    and the longest task, from the Spark event log."""
    import glob
    stage_job = {}
    worst: dict[str, dict] = {}
    for f in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(f) or "appstatus" in f:
            continue
        with open(f, "rb") as fb:
            raw = fb.read()
        if f.endswith(".zstd"):
            import io

            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(
                io.BytesIO(raw), read_across_frames=True).read()
        for line in raw.decode().splitlines():
            if line.strip():
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    name = (e.get("Properties") or {}).get("spark.job.description")
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = name
                elif kind == "SparkListenerTaskEnd":
                    name = stage_job.get(e.get("Stage ID"))
                    if not name:
                        continue
                    m = e.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                            + m.get("Input Metrics", {}).get("Records Read", 0))
                    info = e.get("Task Info", {})
                    dur = (info.get("Finish Time", 0) - info.get("Launch Time", 0)) / 1000
                    w = worst.setdefault(name, {"max_task_records": 0, "max_task_sec": 0.0})
                    w["max_task_records"] = max(w["max_task_records"], recs)
                    w["max_task_sec"] = round(max(w["max_task_sec"], dur), 2)
    return worst


def main():
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    hot = float(sys.argv[2]) if len(sys.argv) > 2 else 1 / 3
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    from tidemark.operators import activity, sessions
    from tidemark.operators.quantiles import exact_quantiles
    from tidemark.session import build_session, scratch_path
    from tidemark.sources import datagen, sinks
    from tests.reference_forms import session_events_by_user_window
    import tempfile
    log_dir = tempfile.mkdtemp(prefix="tidemark-eventlog-", dir="/tmp")
    spark = build_session(f"local[{cpus}]", 4 * cpus, app_name="tidemark-scale",
                          extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": log_dir})
    path = scratch_path(spark, "scale-interactions")
    t0 = time.perf_counter()
    sinks.write_parquet(datagen.interactions(spark.range(rows), hot_share=hot)
                        .repartition(4 * cpus), path)
    gen = round(time.perf_counter() - t0, 2)
    ev = spark.read.parquet(path)
    from tidemark.schemas import EventCols
    cols = EventCols(order="id")
    res = {
        "rows": rows, "hot_share": hot, "cpus": cpus, "generate_sec": gen,
    }
    runs = {
        "dau_exact": lambda: activity.daily_active(ev, cols=cols),
        "mau_rolling_exact": lambda: activity.rolling_active_users(ev, 30, cols=cols),
        "sessions_bucketed": lambda: sessions.sessions(ev, 30, True, cols),
        "session_events": lambda: sessions.session_events(ev, 30, True, cols),
        "event_quartiles": lambda: exact_quantiles(ev, ["duration_ms"], [0.25, 0.75]),
        "session_events_user_window":
            lambda: session_events_by_user_window(ev, 30, True, cols),
    }
    for name, fn in runs.items():
        res[name] = {"sec": timed(spark, name, fn)}
    spark.stop()
    for name, w in largest_tasks(log_dir).items():
        if name in res:
            res[name].update(w)
    print(json.dumps(res))


if __name__ == "__main__":
    main()
