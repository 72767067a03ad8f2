"""Executors need no copy of this repository on their path."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
PROGRAM = """
import importlib.util, os, sys
from pyspark.sql import SparkSession

# Workers start here, and get a path without the repository.
spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", os.getcwd()).config("spark.sql.session.timeZone", "UTC").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
found = spark.sparkContext.parallelize([0], 1).map(lambda _: importlib.util.find_spec("tessera") is not None).first()
assert not found, "the workers see the package"
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry

for name, query in sorted(entry.queries().items()):
    if name.startswith("op"):
        assert query(spark, sys.argv[2]).count() > 0, name
        print("ran", name, flush=True)
"""


def test_all_operators_run_from_another_folder():
    folder = tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")
    path = os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not os.path.exists(os.path.join(p, "tessera")))
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM, REPO, "/root/testdata/sf0.001"], cwd=folder, env=os.environ | {"PYTHONPATH": path}, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran op") == 13
