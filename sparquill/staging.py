"""Tables that cut lineage, in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: list[str] = []
_PATHS: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset a temporary one of our own, on a local master (tests)
    alone: on a cluster executors do not share it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append("file://" + tempfile.mkdtemp(prefix="sparquill-"))
    return _OWN_DIR[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    _PATHS.append(f"{shared_dir(spark)}/sparquill/{uuid.uuid4().hex}")
    return f"{_PATHS[-1]}/{name}"


def clear(spark: SparkSession) -> None:
    """Deletes all staged tables and files of this process; results that read them must have been taken before."""
    for folder in _PATHS:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _PATHS.clear()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: it cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, *frames: DataFrame) -> None:
    """Deletes staged tables that nothing will read again."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots as double underscores) for what is run within; the old ones come back."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
