"""What the jobs need from a session the caller owns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from millrace.functions.jsonschema import uses_time

def enable_time_type(spark: SparkSession, struct: T.StructType) -> None:
    """TIME columns are behind a session flag; turn it on where a schema has one."""
    if uses_time(struct):
        spark.conf.set("spark.sql.timeType.enabled", "true")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for intermediate tables in the shared folder the cluster names.

    Only a local master may do without ``spark.checkpoint.dir``: a cluster's executors don't share local folders.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/millrace-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    return tempfile.mkdtemp(prefix="millrace-")


def _file_system(spark: SparkSession, path: str) -> tuple:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def create_file(spark: SparkSession, path: str, text: str, whole: Callable[[str], bool] = lambda text: True) -> bool:
    """Make a file unless it is there already; tells whether it was made.

    The text is written under another name first and renamed, so no reader and no crash ever leaves a part of it under
    ``path``. A file that is there but not ``whole`` is what an interrupted writer left, and is replaced.
    """
    file_system, target = _file_system(spark, path)
    part = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.part"
    _, source = _file_system(spark, part)
    out = file_system.create(source, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        while not _rename_new(spark, source, target):
            if whole(read_file(spark, path)):
                return False
            file_system.delete(target, False)
        return True
    finally:
        file_system.delete(source, False)


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    file_system, hadoop_path = _file_system(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8", "replace")
    finally:
        stream.close()


def _rename_new(spark: SparkSession, source, target) -> bool:
    """Rename unless the target exists; tells whether it was renamed."""
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise


def allow_duplicate_keys(spark: SparkSession) -> None:
    """The last of several equal keys counts, at every level, as in typed parses."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder a job made itself, on whatever file system it lies."""
    file_system, hadoop_path = _file_system(spark, path)
    file_system.delete(hadoop_path, True)
