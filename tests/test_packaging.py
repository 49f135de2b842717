"""The package reaches the workers when Spark starts elsewhere."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
import sys
sys.path.insert(0, {root!r})
from gridspark.catalog import QUERIES
from gridspark.session import get_spark
spark = get_spark("elsewhere", "local[2]", 2, **{{"spark.ui.showConsoleProgress": "false"}})
print("rows", QUERIES["walk_forward"](spark, {sf!r}).count())
"""


def test_started_from_another_folder(tmp_path, sf):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", JOB.format(root=ROOT, sf=sf)], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
