"""Intermediate tables in the shared folder of the cluster."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from precinct.plans import folders

_SETTING = "spark.checkpoint.dir"
# Shuffle files of a finished execution are deleted, not kept until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a new folder of its
    own, since there the machine is the cluster.
    """
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder all executors can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="precinct-")
    return _local_roots[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that no other run uses."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete the folders of this application; frames that read them are of no more use.

    For the end of a job that has written its results elsewhere.
    """
    for path in _made.pop(spark.sparkContext.applicationId, []):
        folders.remove(spark, path)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written out and read back.

    It is computed once, survives the loss of executors, and later plans know
    its real size. What was shuffled for it is deleted when it is written.
    """
    spark = frame.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    read = spark.read.schema(frame.schema).parquet(path)
    read.scratch_folder = path
    return read


def discard(*frames: DataFrame) -> None:
    """Delete the folders of stored frames that nothing will read any more."""
    for frame in frames:
        folders.remove(frame.sparkSession, frame.scratch_folder)
