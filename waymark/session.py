"""Where results that outlive one job are written, and the session time zone."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
OWN_FOLDER = "waymark"


def shared_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``, else one below the warehouse.

    The same rule holds for every master; both folders are reachable by all executors.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        spark.conf.set(CHECKPOINT_KEY, root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{OWN_FOLDER}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it is."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, with its folders."""
    target, files = _file_system(spark, path)
    files.create(target, True).close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it isn't there."""
    target, files = _file_system(spark, path)
    return [x.getPath().getName() for x in files.listStatus(target)] if files.exists(target) else []


def clear_scratch(spark: SparkSession) -> None:
    """Remove all files that queries have written; call it when no DataFrame reads them any more."""
    remove_path(spark, f"{shared_root(spark)}/{OWN_FOLDER}")


def use_utc(spark: SparkSession) -> None:
    """Window starts and hours follow the session zone, so fix it to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
