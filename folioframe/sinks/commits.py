"""Publishing finished files under a name that nobody else may take: the last step of every versioned write."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer has published this version first; nothing of the own change is visible."""


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def file_system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none where it does not exist."""
    fs, path = file_system(spark, folder), _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def delete(spark: SparkSession, name: str) -> None:
    file_system(spark, name).delete(_path(spark, name), True)


def publish(spark: SparkSession, source: str, target: str) -> None:
    """Renames a finished file or folder; fails with `CommitConflict` where the target is there already."""
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, target).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_path(spark, source), _path(spark, target), options)
    except Py4JJavaError as error:
        delete(spark, source)
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            raise CommitConflict(target) from error
        raise


def publish_text(spark: SparkSession, text: str, target: str) -> None:
    """A small file with all of its text or not at all."""
    folder, name = target.rsplit("/", 1)
    source = f"{folder}/.{name}-{uuid.uuid4().hex}"
    out = file_system(spark, source).create(_path(spark, source), False)
    out.write(text.encode())
    out.close()
    publish(spark, source, target)
