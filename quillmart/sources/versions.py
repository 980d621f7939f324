"""Versions of a stored table.

A version is a small JSON file that names the folders which make up the table;
data files are written first and are never changed. A version is committed by
creating ``_versions/<number>.json`` only if it is absent: of two writers that
read the same version one gets the next number, the other is told so and starts
again from what is there now, so neither loses its rows and readers always see
one whole version.

On a distributed file system that is its create-without-overwrite; for a local
folder (tests) the operating system's exclusive create.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_versions"


class Conflict(RuntimeError):
    """Another writer committed first."""


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text; False if it is there already."""
    fs, p = _fs(spark, path)
    data = text.encode()
    if fs.getScheme() == "file":
        fs.mkdirs(p.getParent())
        try:
            with open(fs.makeQualified(p).toUri().getPath(), "xb") as f:
                f.write(data)
            return True
        except FileExistsError:
            return False
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    out.write(data)
    out.close()
    return True


def _text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def latest(spark: SparkSession, table: str) -> tuple[int, dict]:
    """Number and content of the newest version; (0, {}) before the first."""
    fs, folder = _fs(spark, f"{table}/{FOLDER}")
    if not fs.exists(folder):
        return 0, {}
    numbers = sorted((int(s.getPath().getName()[:-5]) for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")), reverse=True)
    for n in numbers:
        try:
            return n, json.loads(_text(spark, f"{table}/{FOLDER}/{n:012d}.json"))
        except ValueError:  # still being written
            continue
    return 0, {}


def commit(spark: SparkSession, table: str, after: int, content: dict) -> int:
    """Make ``content`` the version that follows ``after``; Conflict if there
    is one already."""
    if not put_if_absent(spark, f"{table}/{FOLDER}/{after + 1:012d}.json", json.dumps(content)):
        raise Conflict(f"{table}: version {after + 1} was committed by another writer")
    return after + 1


def new_folder(table: str, tag: str) -> str:
    """A folder name that no other writer uses, relative to the table."""
    return f"{tag}/{uuid.uuid4().hex}"
