"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(smoke_dir):
    env = {**os.environ, "BENCH_SF_DIR": smoke_dir, "BENCH_CPUS": "2", "BENCH_WARMUP": "0"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "skip_reasons", "plan_tasks"],
                         capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] and d["unit"] == "sec" and d["sf"] == 0.001 and not d["errors"]
    assert set(d["queries"]) == {"skip_reasons", "plan_tasks"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01  # both rounded to ms
