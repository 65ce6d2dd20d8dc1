"""The checkpoint folder, in sessions of their own: the setting is read, never written."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
from quarry.session import cut_lineage, ensure_checkpoint_dir
how, folder = sys.argv[1:]
b = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
spark = (b.config("spark.checkpoint.dir", folder) if how == "named" else b).getOrCreate()
if how == "set":
    spark.sparkContext.setCheckpointDir(folder)
found = {ensure_checkpoint_dir(spark) for _ in range(4)}
depth = {spark.sparkContext.getCheckpointDir() for _ in range(4) if cut_lineage(spark.range(3)).count() == 3}
print("RESULT", len(found), len(depth), found.pop(), depth.pop())
"""


@pytest.mark.parametrize("how", ["unset", "set", "named"])
def test_checkpoint_folder(tmpdir_path, how):
    out = subprocess.run([sys.executable, "-c", SCRIPT, how, tmpdir_path], cwd=ROOT, capture_output=True, text=True, timeout=180,
                         env=os.environ | {"SPARK_CONF_DIR": tmpdir_path})  # no settings but those made here
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    _, folders, depths, folder, used = line[0].split()
    assert (folders, depths) == ("1", "1")
    folder, used = folder.removeprefix("file:"), used.removeprefix("file:")
    assert os.path.dirname(used) == folder and (how == "unset" or folder == tmpdir_path)
