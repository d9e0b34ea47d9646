"""Workers get the code from the session, not from the folder or the path the driver was started with."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as contract
from isochron.session import local_session
spark = local_session(2, shuffle_partitions=2, memory="2g")
for name in ("arima_full", "zip_load"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_started_elsewhere(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
