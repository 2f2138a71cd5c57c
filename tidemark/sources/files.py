"""Small file operations on whatever file system a path names (Hadoop's FileSystem API)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if it isn't there."""
    fs, p = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def tree_stamp(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number, total size and latest change of the files under ``path``, at any depth; zeros
    where there is nothing."""
    fs, p = _fs(spark, path)
    n = size = changed = 0
    if not fs.exists(p):
        return n, size, changed
    files = fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        n, size = n + 1, size + f.getLen()
        changed = max(changed, f.getModificationTime())
    return n, size, changed


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if someone else has it already."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    try:
        fs.create(p, False).close()
    except Exception as e:  # noqa: BLE001 - the file system's own exception comes through py4j
        if fs.exists(p):
            return False
        raise e
    return True


def write_json(spark: SparkSession, path: str, value) -> None:
    """Readers see the whole file or none: written beside it, then renamed."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    part = spark._jvm.org.apache.hadoop.fs.Path(
        p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(part, False)
    try:
        out.write(bytearray(json.dumps(value, indent=1, sort_keys=True).encode()))
    finally:
        out.close()
    if not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(path)


def read_json(spark: SparkSession, path: str):
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
