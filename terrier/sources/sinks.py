"""Where results go: members by family, target tables by municipality, registers, keyed buckets, databases."""

from __future__ import annotations

import contextlib
import re
import urllib.parse
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terrier.sources import folders
from terrier.sources.files import family


def last_members(members: DataFrame) -> DataFrame:
    """One row for each (archive, member): the last entry wins, as when files are extracted over each other.

    Only keys are aggregated; contents meet the winners in a semi-join, so no window carries bytes. Members that could not be
    read are left out.
    """
    rows = members.where("member is not null and content is not null")
    last = rows.groupBy("archive", "member").agg(F.max("member_no").alias("member_no"))
    return rows.join(last, ["archive", "member", "member_no"], "left_semi")


def store_members(members: DataFrame, path: str) -> None:
    last_members(members).withColumn("family", family("member")).withColumn("basename", F.regexp_extract("member", r"([^/]+)$", 1)).write.mode("overwrite").partitionBy("family").parquet(path)


def _by_municipality(df: DataFrame, files_per_municipality: int) -> DataFrame:
    """Rows dealt out so that a large municipality gets several files."""
    return df.repartition("codice", F.pmod(F.xxhash64(*df.columns), F.lit(files_per_municipality)))


def store_targets(tables: dict[str, DataFrame], path: str, files_per_municipality: int = 1) -> None:
    """Each table in a folder of its own, partitioned by municipality. What stood there is gone: see store_delivery() for one that brings some municipalities only."""
    for name, df in tables.items():
        _by_municipality(df, files_per_municipality).write.mode("overwrite").partitionBy("codice").parquet(f"{path}/{name}")


def store_delivery(tables: dict[str, DataFrame], path: str, delivered: DataFrame, files_per_municipality: int = 1) -> None:
    """Bring tables that are partitioned by municipality up to a delivery: municipalities in it are replaced, all others stay.

    delivered: (codice), every municipality that the delivery is about; rows of others are left out. A municipality without rows
    in a table loses those that it had there. Files are written beside the table and put in place by partition when all are
    written, so a delivery that fails halfway can be repeated, and one that came twice changes nothing.
    """
    codes = delivered.select("codice").where("codice is not null").distinct()
    brought = {r.codice for r in codes.toLocalIterator()}  # municipalities, as many as there are folders
    for name, df in tables.items():
        spark, target = df.sparkSession, f"{path}/{name}"
        rows = df.join(codes, "codice", "left_semi").select(*df.columns)
        _by_municipality(rows, files_per_municipality).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("codice").parquet(target)
        # a dynamic overwrite leaves partitions that got no rows
        there = {c: f for f in folders.names(spark, target) if (c := _partition_value(f)) in brought}
        if there:
            filled = {r.codice for r in rows.select("codice").distinct().toLocalIterator()}
            for code in sorted(there.keys() - filled):
                folders.remove(spark, f"{target}/{there[code]}")


def _partition_value(folder: str) -> str | None:
    """The municipality of a folder codice=..., None for any other."""
    key, _, value = folder.partition("=")
    return urllib.parse.unquote(value) if key == "codice" and value != "__HIVE_DEFAULT_PARTITION__" else None


def store_registers(registers: dict[str, DataFrame], path: str) -> None:
    for name, df in registers.items():
        df.write.mode("overwrite").parquet(f"{path}/register={name}")


#: Files of store_kinds() that a task keeps open at most, and about how many bytes of each it holds before they are written.
OPEN_FILES, OPEN_BYTES = 32, 32 << 20


@contextlib.contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """While rows are written by a column of few values, a task keeps a file open for each of them; rows of still more values are sorted as usual."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def store_kinds(df: DataFrame, path: str, key: str) -> None:
    """A folder for each value of key, of which there are few. Rows go to their file as they come: nothing is sorted, so no task holds or spills its rows."""
    with _open_files(df.sparkSession):
        df.write.mode("overwrite").option("parquet.block.size", OPEN_BYTES).partitionBy(key).parquet(path)


def store_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """A table in the session's catalog, dealt out and sorted by keys: tables with as many buckets of the same keys join without a shuffle.

    Rows are dealt out first, so that there is one file for each bucket. path: where its files go, if not to the warehouse.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def _execute(spark: SparkSession, url: str, statements: list[str], properties: dict[str, str]) -> None:
    """Statements of SQL as one transaction of the database."""
    spark._jvm.java.lang.Class.forName(properties["driver"]) if "driver" in properties else None
    settings = spark._jvm.java.util.Properties()
    for k, v in properties.items():
        settings.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.execute(text)
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def store_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], key: str = "codice", connections: int = 8, key_length: int = 64) -> None:
    """Bring a table of a database up to a delivery: rows with a key that the delivery brings are replaced, all others stay.

    The rows go to a table beside it first, over several connections; a task that is tried again adds rows to that table only,
    and they are counted before anything else happens. One transaction then replaces the keys' rows. So a delivery can be
    repeated, and one that fails leaves the table as it was. Rows without a key are left out.
    """
    if not _NAME.fullmatch(table):
        raise ValueError(f"no name of a table: {table}")
    spark, staged = df.sparkSession, f"{table}_delivered"
    rows = df.where(F.col(key).isNotNull()).repartition(connections)
    # keys are compared by the database, which it may not do for long texts
    types = {"createTableColumnTypes": f"{key} varchar({key_length})"} if isinstance(df.schema[key].dataType, StringType) else {}
    rows.limit(0).write.mode("append").options(**types).jdbc(url, table, properties=properties)
    for _ in range(3):
        rows.write.mode("overwrite").options(**types).jdbc(url, staged, properties=properties)
        if spark.read.jdbc(url, staged, properties=properties).count() == rows.count():
            break
    else:
        raise RuntimeError(f"{staged} doesn't hold what was sent to it")
    quoted, columns = f'"{key}"', ", ".join(f'"{c}"' for c in df.columns)
    replace = [f"delete from {table} where {quoted} in (select {quoted} from {staged})", f"insert into {table} ({columns}) select {columns} from {staged}", f"drop table {staged}"]
    _execute(spark, url, replace, properties)
