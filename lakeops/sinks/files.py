"""Path helpers on Hadoop's file system API, for any storage Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def path_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists already. One of two callers wins."""
    fs, target = _open(spark, path)
    fs.mkdirs(target.getParent())
    try:
        return fs.createNewFile(target)
    except Exception as error:  # noqa: BLE001 - a storage may answer by an exception
        if "exist" in str(error).lower():
            return False
        raise


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a path; none if it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]


def rename_path(spark: SparkSession, path: str, new: str) -> None:
    fs, source = _open(spark, path)
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not move {path} to {new}")


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Make a folder that is deleted when the driver's process ends."""
    fs, target = _open(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
