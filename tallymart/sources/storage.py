"""Small files of the driver: read, written, and created only if nobody else has.

They go through Spark's own file systems and settings. Local paths, which Hadoop cannot create
exclusively, are linked into place instead.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# How a file is created only if absent. On ``s3a`` the option below makes the upload a conditional
# request, and is an error where the client does not know it; on ``gs`` a create
# without overwriting is one. Elsewhere a finished file is renamed into place, which fails
# where the name is taken.
CONDITIONAL_OPTION = {"s3a": "fs.option.create.conditional.overwrite", "s3": "fs.option.create.conditional.overwrite"}
CONDITIONAL_CREATE = ("gs",)
TAKEN = ("FileAlreadyExistsException", "RemoteFileChangedException")


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _local(spark: SparkSession, path: str) -> str | None:
    store, where = _located(spark, path)
    return unquote(urlparse(where.makeQualified(store.getUri(), store.getWorkingDirectory()).toUri().getRawPath()).path) \
        if _scheme(store) == "file" else None


def _scheme(store) -> str:
    return store.getUri().getScheme()


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def _write(out, text: str) -> None:
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content; False, and nothing changed, if it is already there."""
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    local = _local(spark, path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        temporary = _local(spark, own)
        with open(temporary, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(temporary, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(temporary)
        return True
    store, where = _located(spark, path)
    try:
        if _scheme(store) in CONDITIONAL_OPTION:
            _write(store.createFile(where).must(CONDITIONAL_OPTION[_scheme(store)], True).build(), text)
            return True
        if _scheme(store) in CONDITIONAL_CREATE:
            _write(store.create(where, False), text)
            return True
        temporary = _located(spark, own)[1]
        _write(store.create(temporary, True), text)
        jvm = spark.sparkContext._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(temporary, where, options)
        except Py4JJavaError:
            store.delete(temporary, False)
            raise
        return True
    except Py4JJavaError as error:
        if _is(error, *TAKEN):
            return False
        raise


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write or replace a file."""
    store, where = _located(spark, path)
    _write(store.create(where, True), text)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a file; None if there is none."""
    store, where = _located(spark, path)
    try:
        stream = store.open(where)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def entries(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder with their time of change in milliseconds; none if there is no folder."""
    store, where = _located(spark, folder)
    try:
        found = store.listStatus(where)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return {}
        raise
    return {status.getPath().getName(): status.getModificationTime() for status in found}


def files(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Size and time of change of a file, or of every file below a folder, by path."""
    store, where = _located(spark, path)
    found, listing = {}, store.listFiles(where, True)
    while listing.hasNext():
        status = listing.next()
        found[str(status.getPath().toString())] = [status.getLen(), status.getModificationTime()]
    return found


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; nothing happens if there is none."""
    store, where = _located(spark, path)
    store.delete(where, True)


def read_json(spark: SparkSession, path: str):
    text = read_text(spark, path)
    return None if text is None else json.loads(text)
