"""Intermediate tables in the folder that driver and executors share, so that lineage ends there and nothing depends on one executor."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a run deletes the shuffle files of its own plan at its end, not when the driver collects its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir.

    Where that is unset, a single-machine session (local master: driver and executors are one process) gets one under
    its warehouse; on a cluster nothing tells a folder that all machines share, so that is an error.
    """
    own = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if own:
        return own
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/skein-shared"


@contextlib.contextmanager
def clean_shuffles(spark: SparkSession) -> Iterator[None]:
    """Runs that begin here leave no shuffle files; the setting is the caller's again afterwards."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def materialize(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Write to the shared folder and read back: lineage and shuffles end there, and a lost executor takes nothing with it."""
    path = f"{shared_dir(spark).rstrip('/')}/skein-{uuid.uuid4().hex}"
    schema = df.schema
    with clean_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._skein_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that materialize() wrote, once nothing reads them any more."""
    for df in tables:
        if path := getattr(df, "_skein_path", None):
            spark = df.sparkSession
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
