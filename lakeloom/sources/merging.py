"""Merges by key that rewrite only the files in which a row changes.

The rows of touched files are written anew beside the table. A commit record, which appears at once,
names what to add and what to remove; then files are moved. A merge that breaks off before its record
has changed nothing, and one that breaks off after it is ended by :func:`recover`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.incremental import has_key, key_list, require_unique
from lakeloom.sources.ledger import alone, publish_mark, read_mark
from lakeloom.sources.skipping import files_with, listing, read_files
from lakeloom.sources.staging import file_system, remove, stage
from lakeloom.sources.tables import FORMAT

#: Under a table's folder; readers skip names with an underscore.
MERGING = "_merging"

_LOCK, _COMMIT, _ROWS = "lock", "commit", "rows"


@dataclass(frozen=True)
class Merged:
    """Files in the table before, those of them rewritten, and those written."""

    files: int
    rewritten: int
    written: int


def _mark(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{MERGING}/{name}"


def _relative(paths: list[str], root: str, spark: SparkSession) -> list[str]:
    """Paths below ``root``, which may be spelt without scheme."""
    files, where = file_system(spark, root)
    base = files.makeQualified(where).toUri().getPath().rstrip("/") + "/"
    plain = [spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in paths]
    return [p.removeprefix(base) for p in plain]


def _finish(spark: SparkSession, folder: str, commit: dict) -> None:
    """Move what the record says; what was moved before is passed over."""
    files, _ = file_system(spark, folder)
    rows = _mark(folder, _ROWS)
    for name in commit["add"]:
        _, new = file_system(spark, f"{rows}/{name}")
        _, place = file_system(spark, f"{folder.rstrip('/')}/{name}")
        if files.exists(new):
            files.mkdirs(place.getParent())
            if not files.rename(new, place):
                raise OSError(f"cannot move {new}")
    for name in commit["remove"]:
        files.delete(file_system(spark, f"{folder.rstrip('/')}/{name}")[1], False)
    remove(spark, _mark(folder, _COMMIT))
    remove(spark, rows)


def recover(spark: SparkSession, folder: str) -> bool:
    """End a merge whose driver was lost; True if its rows have come into the table, False if there was
    none or it had not got so far. Only for when no merge is running."""
    commit = read_mark(spark, _mark(folder, _COMMIT))
    if commit is not None:
        _finish(spark, folder, commit)
    remove(spark, f"{folder.rstrip('/')}/{MERGING}")
    spark.catalog.refreshByPath(folder)
    return commit is not None


def merge_files(
    folder: str,
    source: DataFrame,
    key: str | list[str],
    partition_by: list[str] | None = None,
    schema: T.StructType | None = None,
    fmt: str = FORMAT,
) -> Merged:
    """Let rows of ``source`` replace those of the same key in the table at ``folder``, and add new ones.

    Files without such a key stay as they are, byte for byte. Which these are is found by reading the
    key columns alone, of the files whose extremes in the index of :mod:`lakeloom.sources.skipping`,
    if there is one, reach into the range of the new keys. Rows with a NULL key match nothing and are
    added. Two rows of ``source`` with one key are an error and nothing changes.

    ``schema`` gives the types of the table where its files do not, as those of partitions; ``source``
    must have its columns. Only one merge of a folder runs at a time, another fails with
    :class:`lakeloom.sources.ledger.Taken`. While files are moved a reader may see a key twice.
    """
    spark, keys, parts = source.sparkSession, key_list(key), partition_by or []
    with alone(spark, _mark(folder, _LOCK), {"run": uuid.uuid4().hex}):
        if read_mark(spark, _mark(folder, _COMMIT)) is not None:
            raise RuntimeError(f"a merge of {folder} broke off: recover it first")
        remove(spark, _mark(folder, _ROWS))
        schema = schema or spark.read.format(fmt).load(folder).schema
        typed = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        batch = stage(require_unique(typed.where(has_key(keys)), keys).unionByName(typed.where(~has_key(keys))), "merge")

        ends = batch.agg(*[end(k).alias(f"{name}_{k}") for k in keys for name, end in (("low", F.min), ("high", F.max))]).first()
        wanted = {k: (ends[f"low_{k}"], ends[f"high_{k}"]) for k in keys if ends[f"low_{k}"] is not None}
        candidates = files_with(spark, folder, wanted, schema) if len(wanted) == len(keys) else []
        there = read_files(spark, folder, candidates, schema, fmt).select(*keys, F.col("_metadata.file_path")) if candidates else None
        present = listing(spark, folder).select("path", "file_path")
        if there is None:
            touched = []
        else:
            hits = there.join(batch.select(*keys), keys, "left_semi").select("file_path").distinct()
            # At most the paths that Spark lists on the driver to read the folder.
            touched = [row.path for row in present.join(hits, "file_path", "left_semi").select("path").collect()]

        kept = read_files(spark, folder, touched, schema, fmt).join(batch.select(*keys), keys, "left_anti")
        rows = kept.select(*schema.names).unionByName(batch).hint("rebalance", *parts)
        fresh = _mark(folder, _ROWS)
        writer = rows.write.format(fmt)
        (writer.partitionBy(*parts) if parts else writer).save(fresh)
        added = [row.path for row in listing(spark, fresh).select("path").collect()]
        commit = {"add": _relative(added, fresh, spark), "remove": _relative(touched, folder, spark)}
        before = present.count()
        publish_mark(spark, _mark(folder, _COMMIT), commit)
        _finish(spark, folder, commit)
    spark.catalog.refreshByPath(folder)
    return Merged(before, len(touched), len(added))
