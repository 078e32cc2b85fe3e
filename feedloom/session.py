"""Session helpers shared by the jobs that need cluster folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this cluster.

    ``spark.checkpoint.dir`` wins. Without it only a local master (a unit test, a laptop) gets a
    temporary folder; on a cluster that folder would be the driver's own, so the call raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        folder = configured
    else:
        # py4j gives a Scala Option; a folder set earlier in this session is kept.
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            folder = current.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            folder = tempfile.mkdtemp(prefix="feedloom-ckpt-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, *keys: str, wide: bool = False) -> DataFrame:
    """Rows in as many partitions as keep all cores busy to the end: a fixed number, which stays as it is.

    Pages are small in bytes but costly to walk. Files, and AQE, which gathers shuffled rows by size, would leave
    some of the cores without work. ``wide`` rows, which are sorted where they arrive, lie in as many partitions as other
    shuffles have if these are more, so that a large table's partitions are sorted in memory.
    """
    spark = df.sparkSession
    parts = 4 * spark.sparkContext.defaultParallelism
    return df.repartition(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))) if wide else parts, *keys)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name on the shared storage; its content goes when the application ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder whose content nobody reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows as Parquet on the shared storage and read them back.

    Cuts lineage as a checkpoint does, in fewer bytes, and gives Spark the true size of the rows.
    """
    folder = f"{scratch_folder(df.sparkSession, purpose)}/rows"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
