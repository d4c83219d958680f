"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every mart job relies on. Partition counts and memory are
# left to the cluster: AQE coalesces and splits partitions by measured size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder of its own. On
    a cluster a machine-local folder would lose data with its machine, so a
    missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="martflow-"))
    return context.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/martflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet.

    Everything one application writes there lies below
    ``martflow/<application id>``.
    """
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder.

    For the end of a job: frames that still read from there become unusable.
    """
    delete_folder(spark, _own_folder(spark))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; nothing if it is not there."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on whatever file system it is."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Fixes the result of a plan that must not be evaluated twice and cuts its
    lineage. Being a table in shared storage it outlives lost executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
