"""Where intermediate tables live.

Lineage is cut by writing a Parquet table into the folder that the cluster
names in ``spark.checkpoint.dir``; every executor and the driver can read it
again after an executor is lost.  Only a local session without that setting
gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, tempfile.TemporaryDirectory] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session.

    A session with a cluster master and no ``spark.checkpoint.dir`` is refused:
    a machine-local folder would not be visible to the other machines.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:  # goes with the process
        _LOCAL[app] = tempfile.TemporaryDirectory(prefix="screenwright-", ignore_cleanup_errors=True)
    return f"file://{_LOCAL[app].name}"


def own_folder(spark: SparkSession) -> str:
    """The folder of this application; others may share the root."""
    return f"{shared_root(spark)}/screenwright/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{own_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables of fewer files than cores, and of so many bytes at most, are dealt to all cores.
SMALL_BYTES = 24 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` (a scan) dealt to all cores if it is one small file or a few: a small file is one row group, so one task would do all the work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= SMALL_BYTES and len(df.inputFiles()) < cores else df


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows.

    Beyond that the plain frame is returned, so that the join shuffles.  ``df``
    should be cheap to count (a small aggregate or a materialised table).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def release(spark: SparkSession) -> None:
    """Removes every table that this application has left in the shared folder; results not yet written are lost with them."""
    remove(spark, own_folder(spark))
