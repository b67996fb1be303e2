"""Small files next to the tables, on any store Spark writes to.

Only names and a few KB of text pass through here; rows never do. Access
goes through Spark's own file system classes, so a path may be of any kind
that Spark reads.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession



def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist. One listing call."""
    _, p, fs = _open(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    jvm, p, fs = _open(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that readers see whole or not at all. False if another
    writer was first; the existing file is never replaced."""
    jvm, p, fs = _open(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf)
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    no_overwrite = spark.sparkContext._gateway.new_array(options, 0)
    try:
        context.rename(fs.makeQualified(part), fs.makeQualified(p), no_overwrite)
    except Py4JJavaError as e:
        fs.delete(part, False)
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    _, p, fs = _open(spark, path)
    fs.delete(p, True)
