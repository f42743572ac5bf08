"""The few file operations that published versions need, on any file system that Spark reads."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder; none if there is no such folder."""
    files, place = _at(spark, folder)
    return sorted(entry.getPath().getName() for entry in files.listStatus(place)) if files.exists(place) else []


def leaves(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Paths, relative to ``folder``, of the folders so many levels below it that are named key=value."""
    files, place = _at(spark, "/".join([folder, *["*=*"] * depth]))
    found = [entry.getPath().toString().split("/")[-depth:] for entry in files.globStatus(place) or []]
    return sorted("/".join(parts) for parts in found)


def delete(spark: SparkSession, path: str) -> None:
    """A file or folder with all that is in it; nothing if there is none."""
    files, place = _at(spark, path)
    files.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet: readers see nothing or all of it, and of two writers one fails.

    It is written under another name and renamed without overwriting, which is atomic wherever
    the file system's rename is (HDFS, local disks).
    """
    files, place = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    plain = spark.sparkContext._gateway.new_array(kind, 1)
    plain[0] = kind.NONE
    context = hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, place, plain)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception.toString()):
            raise FileExistsError(path) from error
        raise
