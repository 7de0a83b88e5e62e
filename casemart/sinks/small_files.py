"""Small text files on any file system that Spark reaches: written whole, or only if nobody else has written them."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession



def _store_of(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _write(store, path, text: str, overwrite: bool) -> None:
    out = store.create(path, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that doesn't exist yet; False if somebody else has created it. Of several writers of one path exactly one succeeds.

    Local files appear with their whole content (a hard link to a finished file); elsewhere the store's own create without overwriting decides, and a
    reader may see the file empty until it is closed.
    """
    target, store = _store_of(spark, path)
    if store.getUri().getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        staging = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(staging, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(staging, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(staging)
        return True
    try:
        _write(store, target, text, overwrite=False)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write or replace a file."""
    target, store = _store_of(spark, path)
    _write(store, target, text, overwrite=True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file's content, None if there is no file or nothing in it."""
    target, store = _store_of(spark, path)
    if not store.exists(target):
        return None
    row = spark.read.text(path, wholetext=True).first()
    return row and row[0]


def remove(spark: SparkSession, path: str) -> None:
    target, store = _store_of(spark, path)
    store.delete(target, True)
