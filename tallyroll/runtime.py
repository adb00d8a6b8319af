"""Session settings and staging of intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tallyroll", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Fused code for wide rows is slow to compile and to run; leave it to narrow steps.
        .config("spark.sql.codegen.maxFields", "30")
        # Keep the compiled code of many different queries.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else set on the context.

    A folder of one machine would lose data on a cluster, so none is made up.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return folder.rstrip("/")


def allow_checkpoints(spark: SparkSession) -> None:
    """For estimators that cut their own lineage: they ask the context for the folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tallyroll/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in a folder of this session."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_staged(spark: SparkSession) -> None:
    """Delete all that this session has staged; call it when no result that reads it is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Later readers prune columns, push filters and know the size, and a lost
    executor costs a re-read, not a re-run of the lineage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
