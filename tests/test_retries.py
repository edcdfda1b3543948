"""Jobs survive lost tasks: the first attempt of some tasks fails on purpose
(in a separate process whose session retries tasks) and results stay exact."""

from __future__ import annotations

import os
import subprocess
import sys


def test_results_exact_when_first_attempts_fail():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_job.py")
    done = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=900)
    lines = [ln for ln in done.stdout.splitlines() if ln.split(" ")[0] in
             ("ordinal", "closure", "publish_new", "missing_work", "injected_failures")]
    assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-2000:]
    assert len(lines) == 5, done.stdout
