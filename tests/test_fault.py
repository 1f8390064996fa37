"""A task failure during the replace-by-key write is retried and the table stays exact."""

from __future__ import annotations

import os
import subprocess
import sys

from tests.conftest import SF_SMALL

HERE = os.path.dirname(os.path.abspath(__file__))


def test_write_survives_task_failure():
    proc = subprocess.run([sys.executable, os.path.join(HERE, "fault_run.py"), SF_SMALL],
                          capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stdout[-2000:] + proc.stderr[-4000:]
    assert "equal True" in proc.stdout
