"""Workers get the package from the session, not from a folder on their path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from reelgrove import build_session
from reelgrove.plans import QUERIES
spark = build_session("packaging", master="local[2]", shuffle_partitions=2, **{{"spark.ui.enabled": "false"}})
print("rows", QUERIES["knn_exact"](spark, {small!r}).count())
"""


def test_workers_without_the_source_folder(small, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT, small=small)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert "rows 5000" in done.stdout, done.stderr[-2000:]


def test_a_job_scope_removes_its_intermediates(spark, tmp_path):
    from reelgrove.session import job_scope, stored

    with job_scope(spark) as folder:
        rows = stored(spark.range(10), "numbers")
        assert os.listdir(folder)
        rows.write.parquet(str(tmp_path / "result"))
    assert not os.path.exists(folder)
    assert spark.read.parquet(str(tmp_path / "result")).count() == 10
