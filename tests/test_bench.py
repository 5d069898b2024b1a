import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, "bench.py", "top_artists", "unique_rank"], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"top_artists", "unique_rank"}
    assert rec["sf"] == 0.001
