"""An executor dies while a batch runs: tasks are repeated, nothing is lost or doubled."""

import json
import os
import subprocess
import sys
from pathlib import Path


def test_a_batch_survives_a_lost_executor(tmp_path):
    script = Path(__file__).with_name("lost_executor.py")
    env = {name: value for name, value in os.environ.items() if not name.startswith(("SPARK", "PYSPARK"))}
    done = subprocess.run(
        [sys.executable, str(script), str(tmp_path)], capture_output=True, text=True, timeout=600, env=env, check=False
    )
    lines = [line for line in done.stdout.splitlines() if line.startswith("RESULT ")]
    assert lines, done.stderr[-3000:]
    got = json.loads(lines[0].removeprefix("RESULT "))
    assert got["died"] and got["ok"] and got["difference"] == 0
    for table in ("detail", "rejected", "minutes"):
        assert got[table] == got[f"want_{table}"] > 0
