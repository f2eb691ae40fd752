"""Files that arrive in a drop folder, as a stream: each is handled once, and moved away when its results are committed.

Files are known by their names: a name that was handled is not looked at again, so a later delivery needs names of its own, or
a folder of its own within the drop folder. Each batch has its files listed again by Spark, each in a task of its own unless
folders.few_listings() holds while the stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrier.functions.scalars import legacy_text
from terrier.operators.sheets import parse_sheets
from terrier.sources import folders
from terrier.sources.files import extension, family, numbered, suffix, with_type

#: Suffixes in any case of letters.
SHEETS = "*.[cC][xXtT][fF]"
REGISTERS = "*.{[fF][aA][bB],[tT][eE][rR],[sS][oO][gG],[tT][iI][tT]}"


def _reader(spark: SparkSession, glob: str, archive: str | None, max_files: int = 1000, recursive: bool = False):
    reader = spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", str(recursive).lower())
    return reader.option("cleanSource", "archive").option("sourceArchiveDir", archive) if archive else reader


def arriving(spark: SparkSession, folder: str, glob: str = "*", archive: str | None = None, max_files: int = 1000, recursive: bool = False) -> DataFrame:
    """(filename, content, filetype) of the files of a folder as they come, each one whole. Bytes are UTF-8 if a file is that, and ISO-8859-1 otherwise.

    archive: where Spark moves handled files when a later batch begins; it must lie outside the folder. See move_handled().
    recursive: take the files of folders within it too, with folder, the path of a file's folder below the drop folder.
    """
    files = _reader(spark, glob, archive, max_files, recursive).text(folder, wholetext=True)
    meta = F.col("_metadata")
    inner = [folders.below_of(spark, folder, meta.file_path).alias("folder")] if recursive else []
    return with_type(files.select(*inner, meta.file_name.alias("filename"), legacy_text(F.col("value").cast("binary")).alias("content")))


def _once(rows: DataFrame, out: str, checkpoint: str, by: str | None = None) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(by) if by else writer).start()


def run_once(spark: SparkSession, folder: str, out: str, checkpoint: str, glob: str = SHEETS, archive: str | None = None, recursive: bool = False) -> StreamingQuery:
    """Parse what map sheets have arrived since the last run, and stop. The checkpoint is the ledger of handled files; sheets are written as Parquet."""
    return _once(parse_sheets(arriving(spark, folder, glob, archive, recursive=recursive)), out, checkpoint)


def run_registers_once(spark: SparkSession, folder: str, out: str, checkpoint: str, glob: str = REGISTERS, archive: str | None = None, max_files: int = 1000) -> StreamingQuery:
    """The lines of register files that have arrived since the last run: (filename, line_no, value), in a folder for each batch and register.

    Files are read by line, large ones in many tasks. A batch is written as it was read, then numbered and decoded file by file;
    a batch that is repeated after a failure overwrites what it left.
    """
    meta = F.col("_metadata")
    lines = _reader(spark, glob, archive, max_files).text(folder).select(meta.file_path.alias("path"), meta.file_name.alias("filename"), meta.file_block_start.alias("block"), F.col("value").cast("binary").alias("line"))

    def store(batch: DataFrame, batch_id: int) -> None:
        held = f"{out}-reading/batch={batch_id}"
        batch.withColumn("at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(held)
        rows = numbered(batch.sparkSession.read.parquet(held)).select(extension(suffix("filename")).alias("register"), "filename", "line_no", "value")
        rows.write.mode("overwrite").partitionBy("register").parquet(f"{out}/batch={batch_id}")
        folders.remove(batch.sparkSession, held)

    return lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_drawings_once(spark: SparkSession, folder: str, out: str, checkpoint: str, glob: str = "*", archive: str | None = None) -> StreamingQuery:
    """Files of any other kind (drawings and scans with their indexes) that have arrived: (filename, content), in a folder for each family."""
    files = _reader(spark, glob, archive).format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    named = files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("filename"), "content").withColumn("family", family("filename"))
    return _once(named.where(~F.col("family").isin("map", "register")), out, checkpoint, "family")


def move_handled(spark: SparkSession, folder: str, out: str, archive: str) -> list[str]:
    """Move the files of a folder whose results stand in out (which has their filename, and folder if they lie in folders within it), once a run has ended; their names, with those folders.

    A stream itself moves files only when a later batch begins, so those of its last batch would stay.
    """
    waiting = folders.below(spark, folder)
    if not waiting or not folders.names(spark, out):
        return []
    found = spark.read.parquet(out)
    name = F.concat_ws("/", F.nullif("folder", F.lit("")), "filename") if "folder" in found.columns else F.col("filename")
    done = found.select(name.alias("name")).join(F.broadcast(spark.createDataFrame([(n,) for n in waiting], "name string")), "name", "left_semi").distinct()
    moved = sorted(r.name for r in done.collect())  # at most what the folder holds
    for inner in sorted({n.rpartition("/")[0] for n in moved} | {""}):
        folders.make(spark, f"{archive}/{inner}" if inner else archive)
    folders.move_all(spark, ((f"{folder}/{name}", f"{archive}/{name}") for name in moved))
    return moved
