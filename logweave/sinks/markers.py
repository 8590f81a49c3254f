"""Small marker files that are placed whole or not at all.

``place_once`` puts a file where none is - of several callers one succeeds - and ``place``
replaces one.  Both write the content to a file of its own first and move that into place, so
that no reader sees half a marker.  On the local file system the move is a hard link or a
rename of the operating system; elsewhere it is the store's rename, which refuses an existing
target (HDFS; an object store without atomic renames gives no such promise).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _local(fs, place) -> str | None:
    return place.toUri().getPath() if fs.getScheme() == "file" else None


def _write_new(spark: SparkSession, fs, place, local: str | None, content: str):
    """The content in a fresh file beside the marker, hidden from table scans."""
    name = f".{uuid.uuid4().hex}.tmp"
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        fresh = os.path.join(os.path.dirname(local), name)
        with open(fresh, "w", encoding="utf-8") as file:
            file.write(content)
        return fresh
    fresh = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place.getParent(), name)
    out = fs.create(fresh, False)
    out.write(bytearray(content.encode("utf-8")))
    out.close()
    return fresh


def place_once(spark: SparkSession, path: str, content: str) -> bool:
    """Place a marker unless there is one; whether this call placed it."""
    fs, place = _file_system(spark, path)
    local = _local(fs, place)
    fresh = _write_new(spark, fs, place, local, content)
    if local is not None:
        try:
            os.link(fresh, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(fresh)
    if not fs.exists(place) and fs.rename(fresh, place):
        return True
    fs.delete(fresh, False)
    return False


def place(spark: SparkSession, path: str, content: str) -> None:
    """Place a marker, in the stead of an earlier one if there is one."""
    fs, target = _file_system(spark, path)
    local = _local(fs, target)
    fresh = _write_new(spark, fs, target, local, content)
    if local is not None:
        os.replace(fresh, local)
        return
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fresh, target, options)


def read_marker(spark: SparkSession, path: str) -> str | None:
    """The content of a marker; None where there is none."""
    fs, place_ = _file_system(spark, path)
    local = _local(fs, place_)
    if local is not None:
        try:
            with open(local, encoding="utf-8") as file:
                return file.read()
        except FileNotFoundError:
            return None
    if not fs.exists(place_):
        return None
    stream = fs.open(place_)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()
