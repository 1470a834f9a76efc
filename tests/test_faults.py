"""Lost tasks are retried and the committed results stay exact (separate process)."""

import os
import subprocess
import sys

from tests.conftest import SF_SMALL

HERE = os.path.dirname(os.path.abspath(__file__))


def test_task_failures_do_not_change_results():
    out = subprocess.run([sys.executable, os.path.join(HERE, "fault_run.py"), SF_SMALL],
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.strip().endswith("OK"), out.stdout[-2000:]
