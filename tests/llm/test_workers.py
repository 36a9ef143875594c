"""Every query in a session whose workers neither have the package nor start beside it."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
PROGRAM = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")

def alone(batches):
    import importlib.util
    for b in batches:
        assert importlib.util.find_spec("webfeed") is None
        yield b

spark.range(8).mapInArrow(alone, "id long").collect()
import corpus_pipeline
from webfeed.llm import registry
for name, query in [*registry.QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    assert query(spark, "/root/testdata/sf0.001").count() > 0, name
    print("ran", name, flush=True)
"""


def test_workers_need_not_have_the_package():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", PROGRAM.format(repo=REPO)], cwd=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
                         env=env, capture_output=True, text=True, timeout=1200)
    assert run.returncode == 0, run.stderr[-3000:]
    assert run.stdout.count("ran ") == 14
