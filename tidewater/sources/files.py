"""Directory facts that Spark's readers do not answer, through Hadoop's file system API."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str] | None:
    """Names directly under ``path``; None if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def delete_dir(spark: SparkSession, path: str) -> bool:
    """Delete a directory with all it holds; False if there was none."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def escape_partition_value(spark: SparkSession, value: str) -> str:
    """The directory form of a partition value, as Spark writes it."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(
        value)


def unescape_partition_value(spark: SparkSession, name: str) -> str:
    """A partition value from its directory form."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(
        name)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does.

    The text goes to a hidden file first and is renamed without overwriting, so a
    reader sees all of it or nothing, and of two writers one wins (on file systems
    whose rename is atomic; on others the loser may go unnoticed for an instant).
    """
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    jvm = spark._jvm
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        p.toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(context.makeQualified(temp), context.makeQualified(p),
                       spark.sparkContext._gateway.new_array(kind, 0))
        return True
    except Py4JJavaError as exc:
        fs.delete(temp, False)
        if "FileAlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or directory; the target must not exist."""
    fs, p = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")
