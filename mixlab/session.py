"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "mixlab", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    It comes from ``spark.checkpoint.dir``. Only a local master without that
    setting gets a temporary folder; on a cluster a machine-local folder would
    be lost with its node, so there the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        return folder
    if not context.getCheckpointDir():
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        own = tempfile.mkdtemp(prefix="mixlab-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    return context.getCheckpointDir()


_staged: list[str] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a staged table in the shared folder; ``release_stages`` removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/mixlab-{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def release_stages(spark: SparkSession) -> int:
    """Delete all tables staged by this process so far; call it when their results are written.

    Returns how many were there.
    """
    gone = 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        gone += path.getFileSystem(conf).delete(path, True)
    return gone


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it from there.

    For frames that several jobs read again (model fitting, quantile passes): a
    lost executor then costs a re-read, not the joins below, and each later pass
    reads only the columns it needs.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
