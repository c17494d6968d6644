"""Session defaults and the shared working folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Everything here is an ordinary Spark setting; a cluster may override any of them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Stored pages can be large, so a batch handed to Python is bounded by bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app: str = "tierflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession, most: str = "4m") -> None:
    """From now on the session hands Python about ``most`` bytes at once, or one larger row.

    An executor holds a batch several times over, in its JVM and in Python, for each of its tasks.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a cluster
    a machine-local path would be invisible to the other executors.
    """
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tierflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tierflow/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this package has written below the shared folder.

    Results read their scratch tables when they are used, so this is for the caller, once
    the results of a run have been written or are no longer wanted.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tierflow")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df):
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


_SHIPPED = "_tierflow_shipped"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, whatever directory the driver was started in.

    The zip holds source files only and goes out through Spark's own file service, once
    per context.
    """
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = os.path.join(tempfile.mkdtemp(prefix="tierflow-"), "tierflow.zip")
    with open(target, "wb") as out:
        out.write(packed.getvalue())
    context.addPyFile(target)
    setattr(context, _SHIPPED, True)
