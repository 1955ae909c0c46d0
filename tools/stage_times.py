"""Summarise stage durations from a Spark event-log directory (rolling v2 or single file)."""

import glob
import json
import os
import sys


def main(path: str, top: int = 15) -> None:
    files = [p for p in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(p)]
    stages = {}
    desc = {}
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
        else:
            text = open(f, encoding="utf-8", errors="replace")
        for line in text:
            if not line.startswith("{"):
                continue
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageSubmitted":
                desc[e["Stage Info"]["Stage ID"]] = (e.get("Properties") or {}).get("spark.job.description", "")
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                d = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                stages[si["Stage ID"]] = (d, desc.get(si["Stage ID"], ""), si["Number of Tasks"])
    for k, v in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(k, v)
    by = {}
    for d, name, _ in stages.values():
        by[name] = by.get(name, 0) + d
    print("by step:", sorted(by.items(), key=lambda kv: -kv[1]))
    print("total stage ms", sum(v[0] for v in stages.values()), "stages", len(stages))


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
