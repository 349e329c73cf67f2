import os
import subprocess

from cdcflow import session
from cdcflow.checks.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_shared_folder_is_the_sessions(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and session.shared_dir(spark) == configured
    assert session.new_dir(spark, "x").startswith(configured)
    assert session.new_dir(spark, "x") != session.new_dir(spark, "x")


def test_lineage_is_never_cut_locally():
    found = subprocess.run(
        ["grep", "-rln", "localCheckpoint", os.path.join(ROOT, "cdcflow")], capture_output=True
    )
    assert found.stdout == b""


def test_queries_leave_out_what_needs_a_private_database():
    assert not [name for name in QUERIES if name.startswith("jdbc")]
