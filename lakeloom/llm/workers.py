"""What the Python workers need to know."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_sent: set[str] = set()
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let workers import this package: from where the driver has it where they share its file system, as
    in a local session; elsewhere the session sends them a zip of it."""
    context = spark.sparkContext
    if not context.master.startswith("local"):
        if _ROOT not in _sent:
            _sent.add(_ROOT)
            archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "lakeloom"), "zip", _ROOT, "lakeloom")
            context.addPyFile(archive)
        return
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
