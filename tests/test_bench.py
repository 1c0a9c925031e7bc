import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEAT="1", BENCH_CPUS="2",
               BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py")], env=env, cwd="/tmp", capture_output=True, text=True,
        timeout=900,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert {"q1_daily_change", "q2_peak_month", "q3_quarter_leaders"} <= set(result["queries"])
    assert result["value"] == round(sum(result["queries"][q] for q in
                                        ("q1_daily_change", "q2_peak_month", "q3_quarter_leaders")), 4)
