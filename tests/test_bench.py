"""The benchmark prints one JSON line."""

import json
import os
import subprocess
import sys

from conftest import DATA, ROOT


def test_one_json_line(tmp_path):
    env = {**os.environ, "BENCH_SF_DIR": DATA, "BENCH_CPUS": "2", "BENCH_RUNS": "1"}
    done = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "join_star3"],
        env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300, check=True,
    )
    (line,) = done.stdout.strip().splitlines()
    result = json.loads(line)
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert result["value"] == result["queries"]["join_star3"] > 0
