"""Small files and folders of the cluster's file system, through Hadoop's interface."""

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _open(spark, path)
    return system.exists(folder)


def make(spark: SparkSession, path: str) -> None:
    system, folder = _open(spark, path)
    system.mkdirs(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none if it is not there."""
    system, folder = _open(spark, path)
    if not system.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(folder))


def remove(spark: SparkSession, path: str) -> None:
    system, folder = _open(spark, path)
    system.delete(folder, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename ``source``, unless there is a ``target``; tells whether it did."""
    system, new = _open(spark, target)
    if system.exists(new):
        return False
    system.mkdirs(new.getParent())
    if not system.rename(_open(spark, source)[1], new):
        raise OSError(f"cannot rename {source} to {target}")
    return True


def read_text(spark: SparkSession, path: str) -> str:
    system, file = _open(spark, path)
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; False if there is one already."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    system, file = _open(spark, hidden)
    stream = system.create(file)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if move(spark, hidden, path):
        return True
    system.delete(file, False)
    return False


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    system, folder = _open(spark, path)
    return system.getContentSummary(folder).getLength()


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, bytes and time of each visible file of a folder, in order."""
    system, folder = _open(spark, path)
    found = [(e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in system.listStatus(folder)]
    return sorted(entry for entry in found if entry[0][0] not in "._")
