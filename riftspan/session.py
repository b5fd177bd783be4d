"""Session set-up for the command line, tests and the benchmark, and the checkpoint rule."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "riftspan", shuffle_partitions: int | None = None) -> SparkSession:
    """Session for one machine. On a cluster, submit with the cluster's own configuration instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RIFTSPAN_LOCAL_MEMORY", "12g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def mounted_folder(spark: SparkSession, name: str) -> str:
    """Path of a new entry in the shared folder, for plain file access on the driver."""
    folder = _shared_folder(spark)
    if "://" in folder and not folder.startswith("file://"):
        raise RuntimeError(f"{folder} is not mounted as a file system; name an output or input path instead of -")
    folder = folder.removeprefix("file://").removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="riftspan-checkpoint-")
        context.setCheckpointDir(folder)
    return folder


#: Tables that this process has written to the shared folder.
_written: list[str] = []


def file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, as the session knows it, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def checkpoints_written() -> int:
    """How many tables :func:`reliable_checkpoint` has written that are still there."""
    return len(_written)


def drop_checkpoints(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables of :func:`reliable_checkpoint` but the first ``keep``; for the end of a job, when nothing reads them any more."""
    while len(_written) > keep:
        system, place = file_system(spark, _written.pop())
        system.delete(place, True)


def new_table(spark: SparkSession) -> str:
    """Path for a new table in the shared folder; it is deleted with the others."""
    path = f"{_shared_folder(spark)}/riftspan-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the checkpoint folder of the session and return that table.

    This cuts the lineage, survives the loss of executors, and gives the planner true sizes. The
    folder is the one the cluster names in ``spark.checkpoint.dir``. Only where none is configured,
    as in a bare local session, a fresh temporary folder is used.
    """
    spark = df.sparkSession
    path = new_table(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
