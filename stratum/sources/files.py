"""Small file operations on any path Spark can read (Hadoop file systems)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(path: str):
    """(file system, path) of a URI."""
    sc = SparkSession.active().sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def exists(path: str) -> bool:
    fs, p = _at(path)
    return fs.exists(p)


def listed(pattern: str) -> list[str]:
    """Paths that match a glob, without scheme and authority, in order."""
    fs, p = _at(pattern)
    return sorted(s.getPath().toUri().getPath() for s in fs.globStatus(p) or [])


def remove(path: str) -> None:
    fs, p = _at(path)
    fs.delete(p, True)


def create(path: str, text: str) -> bool:
    """Write a new file whole: under a name of its own, then renamed.  False if
    the path is taken."""
    fs, p = _at(path)
    if fs.exists(p):
        return False
    own = _at(f"{p.getParent().toString()}/.{uuid.uuid4().hex}")[1]
    out = fs.create(own)
    out.write(bytearray(text.encode()))
    out.close()
    return fs.rename(own, p)
