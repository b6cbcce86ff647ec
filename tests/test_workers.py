"""Python workers must not need the package on their path."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
import __spark_entry__ as entry
for name in ("throttle", "stream_throttle", "stream_live_intervals"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_runs_from_another_folder(tmp_path):
    result = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path,
                            capture_output=True, text=True, timeout=300)
    lines = [line.split() for line in result.stdout.splitlines() if line]
    assert [line[0] for line in lines] == ["throttle", "stream_throttle",
                                          "stream_live_intervals"], result.stderr[-2000:]
    assert all(int(line[1]) > 0 for line in lines)
