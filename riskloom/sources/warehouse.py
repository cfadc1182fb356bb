"""Analytic tables: partitioned columnar storage, catalog registration,
partition discovery, CTAS, inspection, and report sinks.

Everything goes through Spark's own catalog and writers (``USING orc`` /
``parquet``); no Hive SerDe DDL is needed.  Table locations are explicit paths
(external tables), so nothing lands in a machine-local warehouse directory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schema as S


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_database(spark: SparkSession, name: str, comment: str | None = None,
                    location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS (idempotent)."""
    sql = f"CREATE DATABASE IF NOT EXISTS {_q(name)}"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def write_table_files(df: DataFrame, path: str, fmt: str = "orc", compression: str = "snappy",
                      partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write ``df`` as columnar files, one directory level per partition column.

    Rows are rebalanced on the partition columns first: adaptive execution
    splits a large partition value over several tasks and merges small ones, so
    the number of files follows the data, not tasks times values.
    """
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]).sortWithinPartitions(*partition_by) if partition_by else df
    writer = out.write.mode(mode).format(fmt).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_bucketed_table(df: DataFrame, name: str, path: str, buckets: int, by: Sequence[str],
                        fmt: str = "orc", compression: str = "snappy",
                        partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write ``df`` as an external catalog table hash-bucketed (and sorted) on
    ``by``.  Tables bucketed on the same key with the same bucket count join
    and aggregate on that key without any shuffle: bucket i of one table meets
    bucket i of the other in the same task.  Rows are dealt out by the bucket
    hash before the write, so a task holds one bucket: at most one file per
    bucket and partition value."""
    writer = (df.repartition(buckets, *by).write.mode(mode).format(fmt).option("compression", compression)
              .option("path", path).bucketBy(buckets, *by).sortBy(*by))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def location_of(spark: SparkSession, name: str) -> str | None:
    """Where the files of an external table are; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = describe(spark, name).where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_q(name)}")


def register_table(spark: SparkSession, name: str, path: str, schema_ddl: str, fmt: str = "orc",
                   partition_by: Sequence[str] = (), comment: str | None = None,
                   options: dict[str, str] | None = None) -> None:
    """Register an external table over existing files (metadata only), in place
    of a table of that name.  ``options`` are data-source options (e.g. ``header``
    for CSV)."""
    drop_table(spark, name)
    sql = f"CREATE TABLE {_q(name)} ({schema_ddl}) USING {fmt}"
    if options:
        sql += " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(partition_by) + ")"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "\\'") + "'"
    sql += f" LOCATION '{path}'"
    spark.sql(sql)


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Register partition directories found under the table location
    (``MSCK REPAIR TABLE``)."""
    spark.catalog.recoverPartitions(name)


def ctas(spark: SparkSession, target: str, source: str, path: str, fmt: str = "orc",
         compression: str = "snappy", buckets: int | None = None,
         bucket_by: Sequence[str] = ()) -> DataFrame:
    """CREATE TABLE ... USING fmt AS SELECT * FROM source (a distributed copy),
    optionally hash-bucketed and sorted on ``bucket_by``, in place of a table of
    that name.  ``path`` must be new."""
    clustered, dealt = "", ""
    if buckets and bucket_by:
        cols = ", ".join(f"`{c}`" for c in bucket_by)
        clustered = f" CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {buckets} BUCKETS"
        dealt = f"/*+ REPARTITION({buckets}, {cols}) */ "  # one bucket per task, as the files are
    drop_table(spark, target)
    spark.sql(f"CREATE TABLE {_q(target)} USING {fmt} "
              f"OPTIONS ('compression' '{compression}'){clustered} LOCATION '{path}' "
              f"AS SELECT {dealt}* FROM {_q(source)}")
    return spark.table(target)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}")


def schema_ddl(table: str, exclude: Sequence[str] = ()) -> str:
    """Column list of a domain table for CREATE TABLE, with column comments."""
    cols = []
    for f in S.SCHEMAS[table]:
        if f.name in exclude:
            continue
        c = f"`{f.name}` {f.dataType.simpleString().upper()}"
        if f.metadata.get("comment"):
            c += " COMMENT '" + f.metadata["comment"].replace("'", "\\'") + "'"
        cols.append(c)
    return ", ".join(cols)


def write_report_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Report sink: CSV with a header.  ``single_file`` sends all rows through
    one task; only for reports with a fixed number of rows."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
