"""Tables that an operator reads more than once, kept in the folder that the cluster shares."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Seconds after which the JVM knows of frames that Python has let go.
RELEASED = 2

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a new local folder, but only on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read back.

    It cuts the lineage: a lost executor costs its running tasks, nothing that is written.
    """
    return kept_at(df, name)[0]


def kept_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """What kept() gives, and the folder, for remove()."""
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that have ended, which it does once the driver collects them.

    Called after kept(), when what was shuffled is written and nothing reads the files again; by itself the
    driver may not collect for half an hour. Spark keeps all files that some frame still needs. Frames that Python
    has let go are released in the JVM by a thread of py4j that looks once a second, so it is waited for; and the
    scheduler holds what the last job read until another one runs.
    """
    gc.collect()
    time.sleep(RELEASED)
    spark.range(1).collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a table of kept_at() that no frame reads any more, what was made of it being written."""
    _written.remove(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_kept(spark: SparkSession) -> None:
    """Delete every table that kept() wrote in this process; frames that read them end."""
    while _written:
        remove(spark, _written[-1])
