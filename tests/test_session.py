"""Configured settings survive, and no machine-local folder is used on a cluster."""

import os
import subprocess
import sys

import pytest

from pricelens import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_submitted_settings_survive():
    code = ("from pricelens.session import get_spark; s = get_spark(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone')); s.stop()")
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=77 --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180).stdout
    assert "GOT local[2] 77 UTC" in out


class Cluster:
    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Cluster())
