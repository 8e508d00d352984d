"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["value"] > 0
    assert {"etl_build", "markov_long", "top_groups"} <= set(rec["queries"])
