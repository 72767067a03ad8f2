"""The command line runs a main flow in its own process."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_timeusage_command(tmp_dir):
    path = os.path.join(tmp_dir, "survey.csv")
    with open(path, "w") as f:
        f.write("tucaseid,telfs,tesex,teage,t010101,t050101,t020101\n1,1,1,20,480,300,60\n2,1,1,21,420,240,120\n")
    out = subprocess.run(
        [sys.executable, "-m", "tessera", "timeusage", path], cwd=REPO, capture_output=True, text=True, timeout=300
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "|working|male|young|         7.5| 4.5|  1.5|" in out.stdout


def test_bench_prints_one_json_line():
    import json

    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_QUERIES="list_sum,rank_langs", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, "bench.py"], cwd=REPO, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"list_sum", "rank_langs"}
    assert result["value"] == round(sum(result["queries"].values()), 4) or abs(result["value"] - sum(result["queries"].values())) < 1e-3
