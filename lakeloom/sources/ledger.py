"""Marks that exactly one writer can make, in the tables' own file system."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from lakeloom.sources.staging import file_system, remove


class Taken(RuntimeError):
    """Another writer has made the mark."""


def claim(spark: SparkSession, path: str, content: dict | None = None) -> None:
    """Make the file ``path``, or fail with :class:`Taken` if it is there.

    Of several writers one succeeds, in every store that can make a file only if it is missing, as HDFS
    and local disks do.
    """
    files, where = file_system(spark, path)
    files.mkdirs(where.getParent())
    try:
        out = files.create(where, False)
    except Py4JJavaError as error:
        if files.exists(where):
            raise Taken(f"{path} is there: {_text(spark, path)}") from error
        raise
    try:
        out.write(bytearray(json.dumps(content or {}).encode()))
    finally:
        out.close()


def _text(spark: SparkSession, path: str) -> str:
    files, where = file_system(spark, path)
    stream = files.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def read_mark(spark: SparkSession, path: str) -> dict | None:
    """What a mark holds; None if it is not there."""
    files, where = file_system(spark, path)
    return json.loads(_text(spark, path) or "{}") if files.exists(where) else None


def publish_mark(spark: SparkSession, path: str, content: dict) -> None:
    """Make the file ``path`` appear with its whole content at once."""
    claim(spark, f"{path}__new", content)
    files, new = file_system(spark, f"{path}__new")
    _, where = file_system(spark, path)
    if not files.rename(new, where):
        raise Taken(path)


@contextmanager
def alone(spark: SparkSession, path: str, content: dict | None = None) -> Iterator[None]:
    """Hold the mark ``path`` for what is done within; another holder's makes it fail with :class:`Taken`.

    A driver that is lost leaves its mark, and whoever knows that it is gone removes it.
    """
    claim(spark, path, content)
    try:
        yield
    finally:
        remove(spark, path)
