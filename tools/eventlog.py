"""Summarise a Spark event log: job and stage wall times (no UI needed).

Usage: python tools/eventlog.py <event-log-file> [top_n]
"""

import io
import json
import sys


def lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        return io.StringIO(data.decode())
    return open(path)


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    jobs, stages = {}, {}
    for line in lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description") or ""
            call = (e.get("Properties") or {}).get("callSite.short") or ""
            jobs[e["Job ID"]] = [e["Submission Time"], None, desc or call, len(e.get("Stage IDs", []))]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                      si["Stage Name"], si["Number of Tasks"])
    t0 = min(j[0] for j in jobs.values())
    print("job  start_s  dur_s  stages  what")
    for jid, (s, e, d, n) in sorted(jobs.items()):
        print(f"{jid:4d} {(s - t0) / 1000:7.2f} {((e or s) - s) / 1000:6.2f} {n:6d}  {d[:70]}")
    print("\nslowest stages")
    for sid, (dur, name, n) in sorted(stages.items(), key=lambda x: -x[1][0])[:top]:
        print(f"{sid:5d} {dur / 1000:6.2f}s tasks={n:4d} {name[:70]}")


if __name__ == "__main__":
    main()
