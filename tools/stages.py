"""Print stage timings from a Spark event log folder (written by bench.py with
BENCH_EVENT_LOG_DIR) — the web UI stays off.

    python tools/stages.py /tmp/run-XXXX
"""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def events(path):
    for f in sorted(glob.glob(f"{path}/**/events_*", recursive=True)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main():
    for e in events(sys.argv[1]):
        if e.get("Event") == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            ms = i.get("Completion Time", 0) - i.get("Submission Time", 0)
            print(f"stage {i['Stage ID']:4d} tasks {i['Number of Tasks']:4d} {ms:6d} ms  {i['Stage Name'][:70]}")


if __name__ == "__main__":
    main()
