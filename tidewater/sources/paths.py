"""File-system questions asked through Spark's own Hadoop configuration."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there. An absent path is the only thing that reads
    as empty anywhere; every other failure raises."""
    hadoop, fs = _located(spark, path)
    return bool(fs.exists(hadoop))


def delete(spark: SparkSession, path: str) -> None:
    hadoop, fs = _located(spark, path)
    fs.delete(hadoop, True)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in milliseconds) of what ``path`` holds."""
    hadoop, fs = _located(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted((s.getPath().getName(), int(s.getModificationTime())) for s in fs.listStatus(hadoop))


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file only if it is absent; False if it is there."""
    from py4j.protocol import Py4JJavaError

    hadoop, fs = _located(spark, path)
    try:
        out = fs.create(hadoop, False)
    except Py4JJavaError as refused:
        if fs.exists(hadoop):
            return False
        raise refused
    out.write(bytearray(text.encode()))
    out.close()
    return True


def scratch_root(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which driver and executors
    share. Only a local session that names none gets a folder of this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tidewater-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
