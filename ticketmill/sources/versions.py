"""A partitioned table whose partitions are replaced by new folders, never in place.

Each load writes its partitions below <path>/data/<load>. Then one row for each partition that the table now
has is written to a folder that no reader looks at, which is renamed to <path>/manifest/version=<n> as the last
step. Readers follow the newest whole manifest, so a load that breaks off, wherever, has changed nothing, and the
next one takes a number that no folder has. If another load took the number first, the switch is tried again on
what that load left; if it replaced partitions of ours, these are made again from its rows. The file system has
to rename a folder in one step, as HDFS and local disks do.

Folders that no manifest names, or only old ones, can be removed while no reader uses them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.sources.sinks import write_zone

MANIFEST = T.StructType(
    [T.StructField("partition", T.StringType()), T.StructField("load", T.StringType())]
)
PREFIX = "version="
#: How often a load tries to switch while others keep getting ahead of it.
ATTEMPTS = 50


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it isn't there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(root)] if system.exists(root) else []


def _whole(spark: SparkSession, path: str) -> bool:
    return any(not name.startswith(("_", ".")) for name in names_in(spark, path))


def newest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """(a number that no manifest has, load of each partition); one row a partition, so it stays small."""
    names = names_in(spark, f"{path}/manifest")
    numbers = sorted((int(n[len(PREFIX) :]) for n in names if n.startswith(PREFIX)), reverse=True)
    free = numbers[0] + 1 if numbers else 1
    for number in numbers:
        folder = f"{path}/manifest/{PREFIX}{number}"
        if _whole(spark, folder):
            rows = spark.read.schema(MANIFEST).parquet(folder).collect()
            return free, {r["partition"]: r["load"] for r in rows}
    return free, {}


def _rows(spark: SparkSession, path: str, schema: T.StructType, loads: dict[str, str]) -> DataFrame:
    folders = [f"{path}/data/{load}/partition={name}" for name, load in sorted(loads.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table in the columns of `schema`; no load yet, no rows."""
    return _rows(spark, path, schema, newest(spark, path)[1])


def _write(df: DataFrame, path: str, partition: str) -> dict[str, str]:
    """The load of each partition that df has, once written; `partition` is df's column with its name."""
    spark, load = df.sparkSession, uuid.uuid4().hex
    rows = df.withColumn("partition", F.col(partition).cast("string"))
    rows = rows if partition == "partition" else rows.drop(partition)
    write_zone(rows, f"{path}/data/{load}", ["partition"], rebalance=True)
    written = spark.read.schema(T.StructType([MANIFEST["partition"]])).parquet(f"{path}/data/{load}")
    return {r["partition"]: load for r in written.distinct().collect()}


def replace_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition: str,
    names: set[str],
    build: Callable[[DataFrame], DataFrame],
) -> None:
    """Replace the partitions `names` by build(their rows now); `partition` is the column of the result with the name.

    A named partition without rows is gone afterwards. Other partitions stay as they are, also those that other
    loads replace at the same time. No names, no change."""
    written, made_from = {}, None
    for _ in range(ATTEMPTS if names else 0):
        number, loads = newest(spark, path)
        mine = {k: v for k, v in loads.items() if k in names}
        if mine != made_from:
            written, made_from = _write(build(_rows(spark, path, schema, mine)), path, partition), mine
        if switch(spark, path, number, {k: v for k, v in loads.items() if k not in names} | written):
            return
    if names:
        raise RuntimeError(f"{path}: other loads took all of {ATTEMPTS} versions")


def switch(spark: SparkSession, path: str, number: int, loads: dict[str, str]) -> bool:
    """Make this manifest the version of that number, unless there is one; whether it is."""
    fresh, target = f"{path}/manifest/_{uuid.uuid4().hex}", f"{path}/manifest/{PREFIX}{number}"
    spark.createDataFrame(list(loads.items()), MANIFEST).coalesce(1).write.parquet(fresh)
    own = {name for name in names_in(spark, fresh) if not name.startswith(("_", "."))}
    jvm = spark._jvm
    source, goal = jvm.org.apache.hadoop.fs.Path(fresh), jvm.org.apache.hadoop.fs.Path(target)
    system = goal.getFileSystem(spark._jsc.hadoopConfiguration())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        # Unlike FileSystem.rename(), this fails on a folder that is there, and never moves into it.
        files.rename(source, goal, no_options)
    except Py4JError:
        if not system.exists(goal):
            raise
    won = own <= set(names_in(spark, target))
    if not won:
        system.delete(source, True)
    return won
