"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

1 warm-up + 3 timed runs per query, median seconds reported. The star schema
is first materialised from the source tables into $BENCH_WORK_DIR (a new
folder under the system's temporary folder if unset: the bench runs in one
local process; facts partitioned by fiscal_year) -- the warehouse load, timed
on its own as ``star_build`` -- and the queries then run against the stored
star, as the reports run against warehouse tables. A second pass runs every
query once with broadcast joins off, which is the plan large dimensions get,
and reports its seconds, shuffle bytes and hash exchanges.

Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revlens.reports import QUERIES  # noqa: E402
from revlens.session import build_session  # noqa: E402
from revlens.sources.star import Star  # noqa: E402


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def _lines(path: str):
    """Lines of an event log file (plain, or zstd as Spark writes by default)."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def shuffle_bytes_by_group(event_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, summed from Spark's event log."""
    stage_group: dict[int, str] = {}
    written: dict[int, int] = {}
    for path in sorted(glob.glob(os.path.join(event_dir, "**", "*"), recursive=True)):
        name = os.path.basename(path)
        if not os.path.isfile(path) or name.startswith((".", "appstatus")):
            continue
        for line in _lines(path):
            if line.strip():
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    sid = ev.get("Stage ID")
                    written[sid] = written.get(sid, 0) + int(m.get("Shuffle Bytes Written", 0))
    out: dict[str, int] = {}
    for sid, b in written.items():
        g = stage_group.get(sid)
        if g:
            out[g] = out.get(g, 0) + b
    return out


def main() -> None:
    load = os.getloadavg()[0]
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    event_dir = os.environ.get("BENCH_EVENT_DIR") or tempfile.mkdtemp(prefix="revlens-events-")
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, cpus * 2))))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=partitions,
                          app_name="revlens-bench",
                          extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": event_dir})
    sc = spark.sparkContext
    work_dir = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="revlens-bench-")
    star_dir = os.path.join(work_dir, f"star-{uuid.uuid4().hex[:8]}")

    build = _timed(lambda: Star.build(spark, sf_dir, star_dir))
    times: dict[str, float] = {}
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        sc.setJobGroup(name, name)
        _force(q(spark, star_dir))  # warm-up
        times[name] = round(statistics.median(_timed(lambda: _force(q(spark, star_dir)))
                                              for _ in range(runs)), 3)
    # the plan used at scale: no dimension is broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    shuffled: dict[str, dict] = {}
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        sc.setJobGroup(f"shuffled:{name}", name)
        df = q(spark, star_dir)
        seconds = round(_timed(lambda: _force(df)), 3)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffled[name] = {"sec": seconds, "hash_exchanges": plan.count("Exchange hashpartitioning")}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    sc.setJobGroup("flagship_from_source", "flagship_from_source")
    # the flagship end to end from the source tables, star derivation included
    flagship = QUERIES["net_sales_by_customer"]
    _force(flagship(spark, sf_dir))
    flagship_sec = round(statistics.median(_timed(lambda: _force(flagship(spark, sf_dir)))
                                           for _ in range(runs)), 3)
    # every report once more, end to end from the source tables (the star is
    # derived inside each plan): one timed run each after the warm-ups above
    from_source: dict[str, float] = {}
    if os.environ.get("BENCH_FROM_SOURCE", "1") == "1":
        for name, q in QUERIES.items():
            if only and name not in only:
                continue
            sc.setJobGroup(f"source:{name}", name)
            from_source[name] = round(_timed(lambda: _force(q(spark, sf_dir))), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    version, parts = spark.version, spark.conf.get("spark.sql.shuffle.partitions")
    spark.stop()  # flushes the event log
    per_group = shuffle_bytes_by_group(event_dir)
    shuffle = {n: per_group.get(n, 0) // (runs + 1) for n in times}
    for n, row in shuffled.items():
        row["shuffle_bytes"] = per_group.get(f"shuffled:{n}", 0)
    print(json.dumps({
        "metric": "sum_of_query_median_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "star_build_sec": round(build, 3),
        "flagship_from_source_sec": flagship_sec,
        "from_source_total_sec": round(sum(from_source.values()), 3),
        "from_source_sec": from_source,
        "cpus": cpus,
        "runs": runs,
        "spark": version,
        "shuffle_partitions": parts,
        "shuffle_bytes_per_run": shuffle,
        "broadcast_off": shuffled,
        "load_average_at_start": load,
        "memory": "spark.driver.memory=16g (local mode: one JVM)",
    }))


if __name__ == "__main__":
    main()
