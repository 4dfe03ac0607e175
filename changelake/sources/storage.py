"""Paths on the cluster's file system."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_GLOB = re.compile(r"([\\{}\[\]*?,])")


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def few_listing_tasks(spark: SparkSession) -> None:
    """List folders in a few tasks a core unless the session sets a number: a log has a folder per batch, and Spark would
    start a task, with a result of its own, for each of the first ten thousand of a shard."""
    if spark.conf.get(_LISTING) == "10000":
        spark.conf.set(_LISTING, str(4 * max(8, spark.sparkContext.defaultParallelism)))


def few_tasks(files: DataFrame) -> DataFrame:
    """Small files in fewer tasks: Spark takes some 30 of them into a task, and each task has a result of its own."""
    most = files.rdd.getNumPartitions()
    return files.coalesce(max(4 * files.sparkSession.sparkContext.defaultParallelism, most // 8))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    target, system = _file_system(spark, path)
    return system.exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, from the root of its file system."""
    target, system = _file_system(spark, path)
    return system.makeQualified(target).toString()


def existing(spark: SparkSession, base: str, names: Sequence[str]) -> list[str]:
    """The paths below `base` that exist, of the given names. Each is asked for by name; no folder is listed."""
    names = [n for n in names if ":" not in n]  # which no file's name can have here
    if not names:
        return []
    # Alternatives that hold a slash are looked up one by one; the leading dot folder gives each of them one.
    wanted = ",".join("./" + _GLOB.sub(r"\\\1", n) for n in names)
    pattern, system = _file_system(spark, f"{_GLOB.sub(r'\\\1', base)}/{{{wanted}}}")
    return [status.getPath().toString() for status in system.globStatus(pattern) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it is not there."""
    target, system = _file_system(spark, path)
    system.delete(target, True)


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is on a local or mounted disk."""
    return qualified(spark, path).startswith("file:")


def local_path(spark: SparkSession, path: str) -> tuple[str, str]:
    """A local path without its scheme, and the encoding in which the JVM names files."""
    target, system = _file_system(spark, path)
    encoding = spark._jvm.java.lang.System.getProperty("sun.jnu.encoding")
    return system.makeQualified(target).toUri().getPath(), encoding


def mark_complete(spark: SparkSession, path: str) -> None:
    """Put the file into a folder by which Spark's writers tell that it is complete."""
    target, system = _file_system(spark, f"{path}/_SUCCESS")
    system.create(target).close()


def epochs_in(spark: SparkSession, table: str) -> list[int]:
    """The epochs a table has complete folders of, oldest first."""
    target, system = _file_system(spark, table)
    if not system.exists(target):
        return []
    names = [status.getPath().getName() for status in system.listStatus(target)]
    found = sorted(int(n.removeprefix("epoch=")) for n in names if re.fullmatch(r"epoch=-?\d+", n))
    return [e for e in found if exists(spark, f"{table}/epoch={e}/_SUCCESS")]


_HOST = r"^[A-Za-z][\w+.-]*:(//[^/]*)?/*"


def plain_path(path: Column) -> Column:
    """A path without its scheme and host, by which two spellings of one file are the same."""
    return F.regexp_replace(path, _HOST, "/")


def plain(path: str) -> str:
    return re.sub(_HOST, "/", path)


def claim(spark: SparkSession, root: str, checkpoint: str) -> None:
    """Let `root` belong to the stream with this checkpoint; another one would mix their epochs."""
    place = f"{root}/owner"
    if exists(spark, f"{place}/_SUCCESS"):
        owner = spark.read.schema("checkpoint string").parquet(place).first()[0]
        if owner != checkpoint:
            raise ValueError(f"{root} belongs to the stream with checkpoint {owner}")
    else:
        spark.createDataFrame([(checkpoint,)], "checkpoint string").write.mode("overwrite").parquet(place)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate files, inside the shared `spark.checkpoint.dir`.

    Only a local session without that setting uses the machine's temporary folder.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="changelake-"))
        shared = context.getCheckpointDir()
    return f"{shared.rstrip('/')}/changelake/{name}-{uuid.uuid4().hex}"
