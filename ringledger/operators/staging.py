"""Intermediate results written once to the cluster's shared folder."""

import tempfile
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine is a temporary folder used
    instead; on a cluster, where executors would not see each other's files, it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or _local_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/ringledger/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"ringledger-{application}-")


def staged(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read back.

    Cuts lineage, survives lost executors, and keeps later reads to the columns and row
    groups they need. Writing to a given ``path`` replaces what is there.
    """
    spark = df.sparkSession
    path = path or shared_folder(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder, on whatever file system it lies."""
    system, folder = _folder(spark, path)
    return system.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a staged copy that is no longer read."""
    system, folder = _folder(spark, path)
    system.delete(folder, True)


@dataclass(frozen=True)
class File:
    """A file of a folder and when it was last changed, in milliseconds."""

    name: str
    modified: int


def listed(spark: SparkSession, path: str) -> list[File]:
    """The files of a folder, none where there is no folder."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    return [File(x.getPath().getName(), x.getModificationTime()) for x in system.listStatus(folder)
            if x.isFile()]


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    system, folder = _folder(spark, path)
    return [x.getPath().getName() for x in system.listStatus(folder) if x.isDirectory()]


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of the files in every folder below ``path``, by the folder's path from there."""
    system, folder = _folder(spark, path)
    base, found = system.makeQualified(folder).toString().rstrip("/") + "/", {}
    files = system.listFiles(folder, True)
    while files.hasNext():
        file = files.next()
        inner = file.getPath().getParent().toString().removeprefix(base)
        found[inner] = found.get(inner, 0) + file.getLen()
    return found


def move_file(spark: SparkSession, path: str, folder: str, other_name: str) -> None:
    """Moves a file into a folder, under another name where its own is taken."""
    system, source = _folder(spark, path)
    _, target = _folder(spark, folder)
    system.mkdirs(target)
    whole = _folder(spark, f"{folder}/{source.getName()}")[1]
    if system.exists(whole):
        whole = _folder(spark, f"{folder}/{other_name}")[1]
    if not system.rename(source, whole):
        raise OSError(f"{path} can't be moved to {folder}")
