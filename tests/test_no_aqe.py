"""Correctness does not depend on AQE: all oracles, AQE off, 200 partitions."""

from __future__ import annotations

import os
import subprocess
import sys

from helpers import SF001


def test_all_oracles_match_without_aqe():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "no_aqe_job.py")
    done = subprocess.run([sys.executable, script, SF001], capture_output=True, text=True, timeout=3600)
    assert done.returncode == 0, done.stdout[-3000:] + done.stderr[-2000:]
    assert "bad 0" in done.stdout
