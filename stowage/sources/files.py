"""Paths on the cluster's file system, reached through the session's Hadoop settings."""

from __future__ import annotations

import os
import random
import re
import time
import urllib.parse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` in full, so that readers, writers and the catalog mean the same place."""
    fs, p = _file_system(spark, path)
    return fs.makeQualified(p).toString()


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def move_in(spark: SparkSession, folder: str, parent: str) -> str:
    """Move ``folder`` into ``parent`` under a fresh name, by one rename; gives the new path."""
    fs, source = _file_system(spark, folder)
    there = f"{parent}/{fresh_name()}"
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(there)):
        raise OSError(f"cannot move {folder} to {there}")
    return there


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with ``text``; False, and no change, where there is one already. One step."""
    fs, p = _file_system(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":
        # Hadoop's local file system looks first and creates then, which is two steps.
        local = urllib.parse.unquote(urllib.parse.urlparse(fs.makeQualified(p).toUri().toString()).path)
        mine = f"{os.path.dirname(local)}/.{fresh_name()}"
        with open(mine, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(mine, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(mine)
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _file_system(spark, path)
    data = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


def files_in(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of change of each file right in ``path``, without those that readers pass over."""
    fs, p = _file_system(spark, path)
    return sorted(
        (s.getPath().toString(), s.getLen(), s.getModificationTime())
        for s in fs.listStatus(p)
        if s.isFile() and not s.getPath().getName().startswith(("_", "."))
    )


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and length of each data file below ``path``, without those that readers pass over."""
    fs, p = _file_system(spark, path)
    found, todo = [], [p]
    while todo:
        for status in fs.listStatus(todo.pop()):
            if status.getPath().getName().startswith(("_", ".")):
                continue
            if status.isDirectory():
                todo.append(status.getPath())
            else:
                found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Make ``path`` and have it removed when the session's JVM ends."""
    fs, p = _file_system(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty where there is no such folder."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def fresh_name() -> str:
    """Time in milliseconds and a random number; holds no ``=``, which Spark would
    take for a partition folder."""
    return f"{time.time_ns() // 1_000_000}_{random.randrange(2**31)}"


def made_at(name: str) -> int | None:
    """The time in a name that ends in one of ``fresh_name``; None for other names."""
    found = re.search(r"(\d{13,})_\d+$", name)
    return int(found[1]) if found else None
