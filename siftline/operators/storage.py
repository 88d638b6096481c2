"""Written intermediates: in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where none is set, a local master gets a folder of its own and a cluster an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="siftline-")
    return _own[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/siftline/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the plan: a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The table written as Parquet in the shared folder and read back, and its path."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _place(spark: SparkSession, path: str):
    """A path and its file system, whatever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage that nothing reads any more."""
    target, fs = _place(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is none."""
    target, fs = _place(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """A small new file, under its name only once it is whole; FileExistsError where there is one."""
    target, fs = _place(spark, path)
    partial, _ = _place(spark, f"{path}.{uuid.uuid4().hex}.partial")
    out = fs.create(partial, True)
    out.write(bytearray(data))
    out.close()
    if fs.exists(target) or not fs.rename(partial, target):
        fs.delete(partial, False)
        raise FileExistsError(path)
