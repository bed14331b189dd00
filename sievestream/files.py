"""Small files on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _located(spark, path)
    return system.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, target = _located(spark, path)
    return system.exists(target) and system.getFileStatus(target).isDirectory()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None where there is none."""
    system, target = _located(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file that appears complete, by a rename; False (and nothing changed) if it is there already."""
    system, target = _located(spark, path)
    if system.exists(target):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(target) or not system.rename(draft, target):
        system.delete(draft, False)
        return False
    return True


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, in order, without hidden files; nothing where there is no such folder."""
    system, target = _located(spark, folder)
    if not system.exists(target):
        return []
    found = (status.getPath().getName() for status in system.listStatus(target))
    return sorted(name for name in found if not name.startswith((".", "_")))


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder; a missing one is fine."""
    system, target = _located(spark, path)
    system.delete(target, True)
