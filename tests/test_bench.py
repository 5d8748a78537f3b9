"""bench.py prints exactly one JSON line in the format the round driver records."""

import json
import os
import subprocess
import sys

import pytest

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_DIR, BENCH_CPUS="4", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"price_list", "market_analysis", "performance_summary"}
    assert result["value"] == pytest.approx(sum(result["queries"].values()), abs=0.01)
