"""What several corpus operators share: tables in the shared folder, words, slices of Arrow batches, free names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


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


def materialize(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and a lost executor takes nothing with it."""
    path = f"{shared_dir(spark).rstrip('/')}/skein-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._skein_path = path
    return out


def discard(df: DataFrame | None, spark: SparkSession) -> None:
    """Delete a table that materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_skein_path", None)
    if path:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have yet."""
    taken, out = {c.lower() for c in df.columns}, f"_{name}"
    while out.lower() in taken:
        out = f"_{out}"
    return out


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def hex16(value: Column) -> Column:
    """A 64-bit number as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def slices(column: pa.Array, most_bytes: int = 4 << 20) -> Iterator[list[str]]:
    """The texts of an Arrow column, nulls as empty, in lists of about most_bytes at most (one text at least)."""
    held, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if held and size + len(text) > most_bytes:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held
