import os
import subprocess
import sys

import pytest

from martflow import session


class _Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    """Just enough of a session to ask where its scratch folder is."""

    def __init__(self, master, **settings):
        self.conf, self.sparkContext = settings, _Context(master)


def test_the_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.scratch_path(spark, "x").startswith(f"{named}/martflow/{spark.sparkContext.applicationId}/x-")


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session("spark://host:7077"))
    named = _Session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert session.shared_dir(named) == "hdfs://shared"


def test_a_local_session_gets_a_folder_once():
    local = _Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
    assert os.path.isdir(session.shared_dir(local))


def test_materialized_rows_are_fixed(spark, rows):
    from pyspark.sql import functions as F

    random = spark.range(100).withColumn("r", F.rand())
    fixed = session.materialize(random, "random")
    assert rows(fixed) == rows(fixed)
    assert fixed.dtypes == random.dtypes


def test_clearing_removes_only_its_own_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    (tmp_path / "martflow" / "other").mkdir(parents=True)
    session.materialize(spark.range(5), "mine")
    assert len(os.listdir(tmp_path / "martflow")) == 2
    session.clear_scratch(spark)
    session.clear_scratch(spark)
    assert os.listdir(tmp_path / "martflow") == ["other"]


def test_a_session_without_the_setting(tmp_path):
    """A process of its own, whose Spark reads no default settings."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from martflow.session import configure, materialize, shared_dir\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "configure(spark)\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert materialize(spark.range(3), 'x').count() == 3\n"
        "assert shared_dir(spark) == shared_dir(spark)\n"
    )
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
