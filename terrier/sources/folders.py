"""Names in a folder of any file system that Spark reaches: listed, moved and removed. No contents pass through here."""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: So many files are renamed at a time.
MOVES = 16


@contextlib.contextmanager
def few_listings(spark: SparkSession) -> Iterator[None]:
    """Within it Spark lists many files or folders in some tasks for each core: by default each of up to 10,000 paths is a task of its own."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _path(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none where there is no such folder."""
    fs, path = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def below(spark: SparkSession, folder: str) -> list[str]:
    """The files of a folder and of those within it, by their path below it, in order; none where there is no such folder. Spark lists them, in tasks where there are many folders; what it takes for hidden (_ or . in front) is left out."""
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    root = fs.makeQualified(path).toUri().getPath().rstrip("/")
    with few_listings(spark):
        found = spark.read.option("recursiveFileLookup", "true").text(folder).inputFiles()
    return sorted(unquote(urlsplit(f).path).removeprefix(root).lstrip("/") for f in found)


def below_of(spark: SparkSession, folder: str, path: Column) -> Column:
    """The folder of a file below another one, from its path as sources state it; empty for files of that folder itself."""
    fs, made = _path(spark, folder)
    root = fs.makeQualified(made).toUri().getRawPath().rstrip("/")
    inner = F.substring(F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit(len(root) + 2), F.length(path))
    return F.url_decode(F.replace(F.regexp_extract(inner, "^(.*)/[^/]*$", 1), F.lit("+"), F.lit("%2B")))


def make(spark: SparkSession, folder: str) -> None:
    fs, path = _path(spark, folder)
    fs.mkdirs(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; what stands at the target is an error."""
    fs, path = _path(spark, source)
    if not fs.rename(path, _path(spark, target)[1]):
        raise OSError(f"can't move {source} to {target}")


def move_all(spark: SparkSession, moves: Iterable[tuple[str, str]]) -> None:
    """Rename files, (source, target) each, of one file system, MOVES of them at a time: one by one, the store's and the gateway's answers would be waited for as often as there are files."""
    moves = list(moves)
    if not moves:
        return
    fs, made = _path(spark, moves[0][0])[0], spark._jvm.org.apache.hadoop.fs.Path

    def one(names: tuple[str, str]) -> None:
        if not fs.rename(*map(made, names)):
            raise OSError("can't move {} to {}".format(*names))

    with ThreadPoolExecutor(MOVES) as pool:
        list(pool.map(one, moves))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all in it; what isn't there is no error."""
    fs, made = _path(spark, path)
    fs.delete(made, True)
