"""bench.py prints exactly one JSON line with the keys the driver reads."""

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
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "injury_by_severity_surface"],
                         capture_output=True, text=True, env=env, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(doc)
    assert doc["unit"] == "sec" and doc["sf"] == "0.001"
    assert set(doc["queries"]) == {"injury_by_severity_surface"} and doc["value"] > 0
