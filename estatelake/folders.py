"""Folder names, sizes and deletion on whatever file system a path names."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty when it does not exist."""
    folder, system = _open(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = _open(spark, path)
    return system.exists(target)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size on storage of everything under a folder."""
    folder, system = _open(spark, path)
    return system.getContentSummary(folder).getLength()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder if it exists."""
    folder, system = _open(spark, path)
    system.delete(folder, True)


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    (from_path, from_system), (to_path, to_system) = _open(spark, source), _open(spark, target)
    util = spark._jvm.org.apache.hadoop.fs.FileUtil
    util.copy(from_system, from_path, to_system, to_path, False, spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    target, system = _open(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file whole, or nothing and False if there is one already.

    Of several writers exactly one succeeds: on local disks by a hard link, elsewhere by
    a rename that does not overwrite, which distributed file systems do at once.
    """
    target, system = _open(spark, path)
    draft, _ = _open(spark, f"{path.rpartition('/')[0]}/_draft-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(text.encode())
    stream.close()
    try:
        _claim(spark, system, draft, target)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
            raise
        return False
    finally:
        system.delete(draft, False)
    return True


def _claim(spark: SparkSession, system, draft, target) -> None:
    jvm, local = spark._jvm, system.getUri().getScheme() == "file"
    if local:
        links = [jvm.java.nio.file.Paths.get(system.makeQualified(p).toUri()) for p in (target, draft)]
        jvm.java.nio.file.Files.createLink(*links)
    else:
        rename_absent(spark, draft, target)


def rename_absent(spark: SparkSession, source, target) -> None:
    """Rename a file; a target that exists is an error."""
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())
