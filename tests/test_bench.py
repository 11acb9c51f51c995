"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="1g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "page_links", "img_jpg"],
                         env=env, capture_output=True, text=True, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001 and result["cpus"] == 2
    assert {"page_links", "img_jpg"} <= set(result["queries"])
    assert abs(result["value"] - sum(result["queries"].values())) < 0.01


def test_oracle_check_from_a_plain_session():
    """As the driver does: its own session, another working folder."""
    script = os.path.join(ROOT, "scripts", "check_oracle.py")
    out = subprocess.run([sys.executable, script, "--plain", SF_SMALL, "distinct_links", "wat_links",
                          "img_jpg", "fan_in"], capture_output=True, text=True, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stdout[-2000:] + out.stderr[-2000:]
    assert out.stdout.count(" OK ") == 4
