"""The code of tasks reaches workers that cannot import the package."""

import os
import subprocess
import sys

from conftest import ROOT, SMALL

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from sensorloom.plans import catalog
from sensorloom.session import build_session

spark = build_session("away", "local[2]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}})
print("scored", catalog.queries()["edge_score"](spark, {SMALL!r}).count())
"""


def test_isolation_forest_from_another_folder(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "scored 1000" in done.stdout, done.stderr[-2000:]
