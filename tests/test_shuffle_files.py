"""Written tables leave no shuffle files behind."""

import os
import subprocess
import sys

CODE = """
import glob, sys, time
from labelloom.session import build_session
from labelloom.llm.common import stored
from labelloom.plans.shared import SHUFFLE_CLEANUP, settle
folder = sys.argv[1]
spark = build_session("shuffles", "local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.local.dir": folder + "/local",
                      "spark.checkpoint.dir": folder + "/shared", "spark.cleaner.referenceTracking": "false"})
before = spark.conf.get(SHUFFLE_CLEANUP, None)
files = lambda: set(glob.glob(folder + "/local/**/shuffle_*.data", recursive=True))
for write in (lambda df: settle(df, "some").df, lambda df: stored(df, "some")):
    earlier = files()
    made = write(spark.range(1000).selectExpr("id % 100 AS k").groupBy("k").count())
    until = time.time() + 20
    while files() - earlier and time.time() < until:
        time.sleep(0.2)
    print("left", len(files() - earlier))
    assert made.count() == 100 and made.agg({"count": "sum"}).first()[0] == 1000
assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
"""


def test_a_written_table_leaves_no_shuffle_files(tmp_path):
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", CODE, str(tmp_path)], env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split("\n")[:2] == ["left 0", "left 0"], (done.stdout, done.stderr[-2000:])
