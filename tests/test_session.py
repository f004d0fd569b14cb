"""A session on a local master that names no checkpoint folder."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
from georisk.session import cut_lineage, get_session
spark = get_session("local[1]", shuffle_partitions=1)
import __spark_entry__ as entry
assert spark.sparkContext.getCheckpointDir()
assert cut_lineage(spark.range(3)).count() == 3
assert entry.queries()["preview"](spark, entry.SMOKE_DIR).count() == 20
print("done")
"""


def test_starts_without_a_configured_checkpoint_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))}
    env |= {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": REPO, "TMPDIR": str(tmp_path)}
    run = subprocess.run([sys.executable, "-c", CODE], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0 and "done" in run.stdout, run.stderr[-2000:]
