"""Tables by catalog name or by path.

A value with a slash is a path, anything else a catalog name. The format is parquet unless
stated; a session with another table format on its classpath can name it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sources.ledger import alone
from lakeloom.sources.staging import file_system, remove, spent, stage

FORMAT = "parquet"


def _is_path(table: str) -> bool:
    return "/" in table


def read(
    spark: SparkSession,
    table: str,
    fmt: str = FORMAT,
    schema: T.StructType | str | None = None,
    where: dict[str, list | tuple] | None = None,
) -> DataFrame:
    """Scan a table.

    ``schema`` is for a folder whose files do not tell it, such as the types of its partitions.
    ``where`` maps columns to a list of values or the ends of a range that are wanted, see
    :func:`lakeloom.sources.skipping.read_where`: of a folder, files that by its index hold none of them
    are not opened; a named table is filtered.
    """
    from lakeloom.sources import skipping

    if where is not None and _is_path(table):
        declared_as = spark.createDataFrame([], schema).schema if schema is not None else None
        return skipping.read_where(spark, table, where, fmt, declared_as)
    reader = spark.read.format(fmt) if schema is None else spark.read.format(fmt).schema(schema)
    found = reader.load(table) if _is_path(table) else reader.table(table)
    return found if where is None else found.where(skipping.condition(where))


def read_sql(spark: SparkSession, path: str, fmt: str = FORMAT) -> DataFrame:
    """Scan a path table through SQL."""
    quoted = path.replace("`", "``")
    return spark.sql(f"select * from {fmt}.`{quoted}`")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Name ``df`` for SQL in this session."""
    df.createOrReplaceTempView(name)
    return df


def sql_text(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _replacing(spark: SparkSession, fresh: str, folder: str) -> Iterator[None]:
    """Put ``fresh`` in the place of ``folder`` for what is done within; if that fails, ``folder`` is back
    as it was, else what it held is removed."""
    files, new = file_system(spark, fresh)
    _, present = file_system(spark, folder)
    _, aside = file_system(spark, f"{folder.rstrip('/')}__old-{uuid.uuid4().hex}")
    had = files.exists(present)
    if had and not files.rename(present, aside):
        raise OSError(f"cannot move {folder}")
    files.mkdirs(present.getParent())
    moved = files.rename(new, present)
    try:
        if not moved:
            raise OSError(f"cannot move {fresh} to {folder}")
        yield
    except BaseException:
        if moved:
            files.rename(present, new)
        if had:
            files.rename(aside, present)
        raise
    if had:
        files.delete(aside, True)


def declared(schema: T.StructType) -> T.StructType:
    """``schema`` as a table declares it: every column may be NULL."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def quoted(names: list[str]) -> str:
    """Column names for SQL, separated by commas."""
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def _find_partitions(spark: SparkSession, table: str) -> None:
    """Let the catalog's partitions be those in the table's folder, each where it lies now."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"msck repair table {table} sync partitions")


def _take_name(spark: SparkSession, fresh: str, table: str) -> None:
    """Give ``fresh`` the name ``table``, and drop what had it; if that fails, the name is back where it was.

    Renaming a managed table moves its folder, while its partitions still point to where they were.
    They are found anew at once: dropping a table removes the folders of its partitions.
    """
    aside = f"{table}__old_{uuid.uuid4().hex}"
    had = spark.catalog.tableExists(table)

    def rename(old: str, new: str) -> None:
        spark.sql(f"alter table {old} rename to {new}")
        _find_partitions(spark, new)

    if had:
        rename(table, aside)
    try:
        rename(fresh, table)
    except BaseException:
        if spark.catalog.tableExists(table):
            rename(table, fresh)
        if had:
            rename(aside, table)
        raise
    if had:
        spark.sql(f"drop table {aside}")


def _register(spark: SparkSession, table: str, schema: T.StructType, fmt: str, folder: str, partition_by: list[str]) -> None:
    """An external table over a folder with the types that its rows had, not those its files suggest."""
    fresh = f"{table}__new_{uuid.uuid4().hex}"
    columns = spark.createDataFrame([], declared(schema))._jdf.schema().toDDL()
    parts = f"partitioned by ({quoted(partition_by)})" if partition_by else ""
    try:
        spark.sql(f"create table {fresh} ({columns}) using {fmt} {parts} location {sql_text(folder)}")
        _find_partitions(spark, fresh)
        _take_name(spark, fresh, table)
    finally:
        spark.sql(f"drop table if exists {fresh}")


def write_overwrite(
    df: DataFrame,
    table: str,
    path: str | None = None,
    fmt: str = FORMAT,
    partition_by: list[str] | None = None,
    **options: str,
) -> None:
    """Replace a table's content. ``path`` makes a named table external; ``options`` go to the writer.

    The rows are first written beside the table and then put in its place by renaming, so a failed
    write, or a failure in renaming, leaves the old content. Renaming is not atomic in every store: a
    reader in that moment may find no table or none of its partitions, and a driver lost in it leaves
    the old content under a name with ``__old``. ``df`` may read the table it replaces.

    A named table has the columns and types of ``df``, with those of ``partition_by`` last. A value of a
    partition comes back as it was, a NULL too; only an empty string becomes NULL, as Spark stores both
    alike. The rows of one partition are brought together in files of the advised size of adaptive
    execution, and a partition with most of the rows is written by many tasks. A partitioned table
    without a name has no types of its own: pass :func:`read` its schema.
    """
    spark, parts = df.sparkSession, partition_by or []
    rows = df.hint("rebalance", *parts) if parts else df
    writer = rows.write.format(fmt).options(**options)
    if parts:
        writer = writer.partitionBy(*parts)
    folder = table if _is_path(table) else path
    mark = uuid.uuid4().hex
    if folder is None:
        fresh = f"{table}__new_{mark}"
        try:
            with spent(spark):
                writer.saveAsTable(fresh)
            _take_name(spark, fresh, table)
        finally:
            spark.sql(f"drop table if exists {fresh}")
        return
    fresh = f"{folder.rstrip('/')}__new-{mark}"
    try:
        with spent(spark):
            writer.save(fresh)
        with _replacing(spark, fresh, folder):
            if not _is_path(table):
                _register(spark, table, df.schema, fmt, folder, parts)
                spark.catalog.refreshTable(table)
    except BaseException:
        # The old folder is back, so its partitions are looked up once more.
        if not _is_path(table) and spark.catalog.tableExists(table):
            _find_partitions(spark, table)
            spark.catalog.refreshTable(table)
        raise
    finally:
        remove(spark, fresh)
    spark.catalog.refreshByPath(folder)


def write_append(
    df: DataFrame,
    table: str,
    path: str | None = None,
    fmt: str = FORMAT,
    batch_id: str | None = None,
    **options: str,
) -> None:
    """Append rows; ``options`` go to the writer, and those of the first write of a named table stay its own.

    Without ``batch_id`` every call adds its rows again. With it the rows go to the partition
    ``batch_id=<value>``, and a second run of the same batch replaces that partition, also by no
    rows at all. Of two runs of one batch at a time the second fails with
    :class:`lakeloom.sources.ledger.Taken`; the mark that tells it lies in the table's folder.
    """
    if batch_id is None:
        writer = df.write.format(fmt).options(**options).mode("append")
        with spent(df.sparkSession):
            if _is_path(table):
                writer.save(table)
            else:
                (writer.option("path", path) if path else writer).saveAsTable(table)
        return

    spark = df.sparkSession
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch_id)
    if not _is_path(table) and not spark.catalog.tableExists(table):
        # Of two first writers of a named table one finds that it is there.
        # Observing the rows keeps the constant above a union, where it is known to need no sort.
        seen = df.observe(f"batch-{uuid.uuid4().hex}", F.count("*").alias("rows"))
        first = seen.withColumn("batch_id", F.lit(batch_id)).write.format(fmt).options(**options).partitionBy("batch_id")
        with spent(spark):
            (first.option("path", path) if path else first).saveAsTable(table)
        return
    folder = (table if _is_path(table) else location(spark, table)).rstrip("/")
    with alone(spark, f"{folder}/_batches/{name}", {"batch": batch_id}):
        if _is_path(table):
            fresh = f"{folder}__new-{uuid.uuid4().hex}"
            try:
                with spent(spark):
                    df.write.format(fmt).options(**options).save(fresh)
                with _replacing(spark, fresh, f"{folder}/batch_id={name}"):
                    pass
            finally:
                remove(spark, fresh)
            return
        # Written first, so that a failure in computing the rows leaves the batch as it was.
        rows = stage(df, "batch")
        view = f"batch_{uuid.uuid4().hex}"
        order = ", ".join(f"`{c}`" for c in spark.table(table).columns if c != "batch_id")
        rows.createOrReplaceTempView(view)
        try:
            spark.sql(
                f"insert overwrite table {table} partition (batch_id = {sql_text(batch_id)}) select {order} from {view}"
            )
        finally:
            spark.catalog.dropTempView(view)


def location(spark: SparkSession, table: str) -> str:
    """The folder of a named table."""
    told = spark.sql(f"describe table formatted {table}").where("col_name = 'Location'").first()
    return told["data_type"]


def swap(df: DataFrame, table: str, root: str, fmt: str = FORMAT, keep: int = 1) -> str:
    """Replace a named table by a result that may read its present content.

    The rows are written to a fresh folder under ``root`` and the catalog entry is then pointed
    at it, so readers see the old or the new content and a failed write changes nothing. Returns
    the new folder. The last ``keep`` folders before it stay, for readers that still use them.
    """
    spark = df.sparkSession
    location = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.format(fmt).save(location)
    if spark.catalog.tableExists(table):
        spark.sql(f"alter table {table} set location {sql_text(location)}")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=location, source=fmt, schema=df.schema)
    files, where = file_system(spark, root)
    older = [f for f in files.listStatus(where) if f.getPath().getName().startswith("v-")]
    older.sort(key=lambda f: (f.getPath().getName() == location.rsplit("/", 1)[1], f.getModificationTime()))
    for folder in older[: max(0, len(older) - 1 - keep)]:
        files.delete(folder.getPath(), True)
    return location
