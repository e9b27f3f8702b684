"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_LITERAL="0")
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "first_vs_repeat", "event_paths"],
                          env=env, capture_output=True, text=True, timeout=600)
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert proc.returncode == 0 and len(lines) == 1, proc.stderr[-2000:]
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"first_vs_repeat", "event_paths"}
    assert abs(out["value"] - sum(out["queries"].values())) < 1e-6
