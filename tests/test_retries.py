import subprocess
import sys
from pathlib import Path


def test_results_survive_task_retries():
    """Separate process (one SparkContext per JVM): local[4,3] retries failed tasks."""
    script = Path(__file__).with_name("retry_job.py")
    proc = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600)
    assert "RETRY-OK" in proc.stdout, proc.stdout[-2000:] + proc.stderr[-4000:]
    assert "injected task failure" in proc.stderr  # failures really happened and were retried
