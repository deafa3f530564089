"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDERS: set[str] = set()
#: Drops a query's shuffles as it ends; a table that has been written needs them no more.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder only where it is unset on a one-process local master, as in tests."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="strataforge-")
    sc.setCheckpointDir(folder)
    return folder


def _delete(sc: SparkContext, path: str) -> None:
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jvm.org.apache.hadoop.conf.Configuration() if sc._jsc is None else sc._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage, survives lost executors.

    The application owns the table: free() deletes it, and what is left goes when the driver ends.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/strataforge-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_leave, spark.sparkContext, folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def _leave(sc: SparkContext, folder: str) -> None:
    try:
        _delete(sc, folder)
    except (Py4JError, OSError, AttributeError):  # the JVM went first
        pass


def free(*tables: DataFrame) -> None:
    """Deletes staged tables that no later step reads."""
    for table in tables:
        _delete(table.sparkSession.sparkContext, table._staged_at)


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, as alias=name. A name that is there exactly is that column, whatever others differ from it in case only."""
    found = df.columns
    wide = df.toDF(*[f"_{k}" for k in range(len(found))])

    def place(name: str) -> str:
        same = [k for k, c in enumerate(found) if c == name] or [k for k, c in enumerate(found) if c.lower() == name.lower()]
        if not same:
            raise ValueError(f"there is no column {name}")
        return f"_{same[0]}"

    return wide.select(*[F.col(place(name)).alias(alias) for alias, name in names.items()])


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns that the named outputs would clash with."""
    low = {n.lower() for n in names}
    keep = [k for k, c in enumerate(df.columns) if c.lower() not in low]
    wide = df.toDF(*[f"_{k}" for k in range(len(df.columns))])
    return wide.select(*[F.col(f"_{k}").alias(df.columns[k]) for k in keep])
