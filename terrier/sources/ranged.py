"""Zip archives read by ranges of bytes: large ones are split among tasks, and no task holds more than one member.

A file of any store that Spark reads is taken as lines of bytes, which its text source splits wherever it likes, packed into
chunks; sums over blocks give each chunk its place in the file. The end of an archive names its directory, the directory names
each member's range, and the chunks of a range meet in the task that unpacks the member.
"""

from __future__ import annotations

import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrier.sources.files import _UNREADABLE, members_of

#: Bytes of a chunk, about; ranges and chunks meet by cells of this size.
CHUNK = 1 << 20
#: Where an archive's end record is looked for: it has 22 bytes and a comment, with the larger form's two records before it.
END_BYTES = 22 + 65_535 + 76
_END, _ENTRY, _LARGE = b"PK\x05\x06", b"PK\x01\x02", 0xFFFFFFFF


def read_chunks(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, block, inner, bytes): the bytes of files, in order within a block. Each chunk ends with a line feed, which the file's last byte needn't be."""
    reader = spark.read.option("lineSep", "\n")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    meta = F.col("_metadata")
    lines = reader.text(path).select(meta.file_path.alias("path"), meta.file_block_start.alias("block"), F.col("value").cast("binary").alias("line"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, inner = None, [], 0, 0

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([inner], pa.int64()), pa.array([b"\n".join(held) + b"\n"], pa.binary())], ["path", "block", "inner", "bytes"])

        for batch in batches:
            paths, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_pylist()
            names = paths.dictionary.to_pylist()
            for name, block, line in zip(paths.indices.to_pylist(), blocks, batch.column(2).to_pylist(), strict=True):
                if (names[name], block) != key or size >= CHUNK:
                    if held:
                        yield out()
                    inner = inner + size if (names[name], block) == key else 0
                    key, held, size = (names[name], block), [], 0
                held.append(line)
                size += len(line) + 1
        if held:
            yield out()

    return lines.mapInArrow(pack, "path string, block long, inner long, bytes binary")


def placed(chunks: DataFrame) -> DataFrame:
    """(path, start, bytes) of written chunks: where each begins in its file. One row for each block is ordered by file."""
    blocks = chunks.groupBy("path", "block").agg(F.sum(F.octet_length("bytes").cast("long")).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return chunks.join(blocks.select("path", "block", before.alias("before")), ["path", "block"]).select("path", (F.col("before") + F.col("inner")).alias("start"), "bytes")


def slices(chunks: DataFrame, ranges: DataFrame) -> DataFrame:
    """(path, range_no, start, bytes): what chunks hold of ranges(path, range_no, from, to), in pieces. Both meet by cells of CHUNK bytes, so a hot archive is spread."""
    size = F.octet_length("bytes")
    cell = lambda c: F.floor(c / CHUNK).cast("long")
    held = chunks.withColumn("end", F.col("start") + size).withColumn("first", cell(F.col("start"))).withColumn("cell", F.explode(F.sequence("first", cell(F.col("end") - 1))))
    asked = ranges.where("to > from").withColumn("of", cell(F.col("from"))).withColumn("cell", F.explode(F.sequence("of", cell(F.col("to") - 1))))
    # a chunk and a range that share several cells meet in the first one
    met = held.join(asked, ["path", "cell"]).where((F.col("cell") == F.greatest("first", "of")) & (F.col("start") < F.col("to")) & (F.col("end") > F.col("from")))
    begin = F.greatest(F.col("start"), F.col("from"))
    piece = F.substring("bytes", (begin - F.col("start") + 1).cast("int"), (F.least("end", "to") - begin).cast("int"))
    return met.select("path", "range_no", begin.alias("start"), piece.alias("bytes"))


def _whole(t: pa.Table) -> bytes:
    return b"".join(x for _, x in sorted(zip(t["start"].to_pylist(), t["bytes"].to_pylist(), strict=True)))


def _end_of(tail: bytes, start: int) -> tuple[int, int]:
    """Where an archive's directory begins, and what must be added to the places that it names. tail: the file's last bytes, from start on."""
    at = tail.rfind(_END)
    if at < 0 or len(tail) < at + 22:
        raise zipfile.BadZipFile("File is not a zip file")
    size, begin = struct.unpack_from("<LL", tail, at + 12)
    end = at
    if at >= 76 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        end = at - 76
        if tail[end : end + 4] != b"PK\x06\x06":
            raise zipfile.BadZipFile("no end record of a large archive")
        size, begin = struct.unpack_from("<QQ", tail, end + 40)
    directory = start + end - size
    if directory < 0:
        raise zipfile.BadZipFile("the directory is larger than the archive")
    return directory, directory - begin


def _entries(directory: bytes) -> Iterator[tuple[bytes, int]]:
    """The entries of a directory, and where each says that its member begins."""
    at = 0
    while directory[at : at + 4] == _ENTRY:
        name, extra, comment = struct.unpack_from("<HHH", directory, at + 28)
        entry = directory[at : at + 46 + name + extra + comment]
        if len(entry) < 46 + name + extra + comment:
            raise zipfile.BadZipFile("the directory ends within an entry")
        packed, plain = struct.unpack_from("<LL", entry, 20)
        (begin,) = struct.unpack_from("<L", entry, 42)
        if begin == _LARGE:
            more, k = entry[46 + name : 46 + name + extra], 0
            while k + 4 <= len(more):
                kind, length = struct.unpack_from("<HH", more, k)
                if kind == 1:
                    (begin,) = struct.unpack_from("<Q", more, k + 4 + 8 * ((plain == _LARGE) + (packed == _LARGE)))
                k += 4 + length
        yield entry, begin
        at += len(entry)


def _alone(entry: bytes, member: bytes) -> bytes:
    """An archive of one member: its bytes, its entry and an end."""
    entry = entry[:42] + struct.pack("<L", 0) + entry[46:]
    return member + entry + _END + struct.pack("<HHHHLLH", 0, 0, 1, 1, len(entry), len(member), 0)


def expand_ranged(spark: SparkSession, path: str, work: str, glob: str = "*.zip", nested: int = 1, archive: Column | None = None) -> DataFrame:
    """(archive, member_no, member, content, error) of the archives of a path, as expand_archives() gives them, however large an archive is.

    member_no keeps the order of members, with gaps. A task holds one member at a time (a nested archive is one), or the
    directory of one archive. work: a folder for what is read and planned. Files that are no archives give a
    row with only the error; empty files give none, as Spark's file sources pass them over.
    archive: the name of an archive, from the path of its file; else the file's name.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("archive"), "length")
    if archive is not None:
        files = files.withColumn("archive", archive)
    read_chunks(spark, path, glob).write.mode("overwrite").parquet(f"{work}/chunks")
    chunks = placed(spark.read.parquet(f"{work}/chunks"))

    def ends(t: pa.Table) -> pa.Table:
        try:
            begin, shift = _end_of(_whole(t), min(t["start"].to_pylist()))
            out = begin, shift, None
        except _UNREADABLE as e:
            out = None, None, f"{type(e).__name__}: {e}"
        return pa.table([pa.array([t["path"][0].as_py()]), pa.array([out[0]], pa.int64()), pa.array([out[1]], pa.int64()), pa.array([out[2]], pa.string())], ["path", "begin", "shift", "error"])

    tails = slices(chunks, files.select("path", F.lit(0).alias("range_no"), F.greatest(F.lit(0), F.col("length") - END_BYTES).alias("from"), F.col("length").alias("to")))
    found = tails.groupBy("path").applyInArrow(ends, "path string, begin long, shift long, error string")
    found.write.mode("overwrite").parquet(f"{work}/ends")
    found = files.join(spark.read.schema(found.schema).parquet(f"{work}/ends"), "path", "left")

    def plan(t: pa.Table) -> pa.Table:
        path_, directory = t["path"][0].as_py(), min(t["start"].to_pylist())
        shift, rows, error = t["shift"][0].as_py(), [], None
        try:
            rows = [(k, entry, begin + shift) for k, (entry, begin) in enumerate(_entries(_whole(t)))]
        except _UNREADABLE as e:
            error = f"{type(e).__name__}: {e}"
        # a member ends where the next one begins, in the order of places
        at = sorted({b for _, _, b in rows} | {directory})
        end = dict(zip(at, at[1:], strict=False))
        columns = [[path_] * len(rows), [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [end.get(r[2], r[2]) for r in rows], [None] * len(rows)]
        if error:
            columns = [c + [x] for c, x in zip(columns, (path_, None, None, None, None, error), strict=True)]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["path", "range_no", "entry", "from", "to", "error"])

    good = found.where("begin is not null")
    directories = slices(chunks, good.select("path", F.lit(0).alias("range_no"), F.col("begin").alias("from"), F.col("length").alias("to")))
    planned = directories.join(good.select("path", "shift"), "path").groupBy("path").applyInArrow(plan, "path string, range_no long, entry binary, from long, to long, error string")
    planned.write.mode("overwrite").parquet(f"{work}/members")
    planned = spark.read.schema(planned.schema).parquet(f"{work}/members").join(files.select("path", "archive"), "path")

    kinds = {"archive": pa.string(), "member_no": pa.int64(), "member": pa.string(), "content": pa.binary(), "error": pa.string()}

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order, for each range its entry and then its pieces: members, in batches of bounded bytes."""
        held, pieces_, size = [], [], 0
        key = archive_ = entry = None

        def unpacked() -> list[tuple]:
            no = key[1]
            try:
                return [(archive_, (no << 20) + k, *m) for k, m in enumerate(members_of(_alone(entry, b"".join(pieces_)), nested))]
            except _UNREADABLE as e:
                return [(archive_, no << 20, None, None, f"{type(e).__name__}: {e}")]

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds.values(), strict=True)], list(kinds))

        for batch in batches:
            for path_, no, piece, name, of in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (path_, no) != key:
                    if key:
                        held += (more := unpacked())
                        size += sum(len(m[3] or b"") for m in more)
                    if held and (size > CHUNK or len(held) >= 10_000):
                        yield out()
                        held, size = [], 0
                    key, archive_, entry, pieces_ = (path_, no), name, of, []
                else:
                    pieces_.append(piece)
        held += unpacked() if key else []
        if held:
            yield out()

    ranges = planned.where("to > from")
    entries = ranges.select("path", "range_no", F.lit(-1).cast("long").alias("start"), F.lit(None).cast("binary").alias("bytes"), "archive", "entry")
    pieces = slices(chunks, ranges.select("path", "range_no", "from", "to")).withColumns({"archive": F.lit(None).cast("string"), "entry": F.lit(None).cast("binary")})
    # not a group for each member, as a task has thousands of small ones
    ordered = pieces.unionByName(entries).repartition("path", "range_no").sortWithinPartitions("path", "range_no", "start")
    members = ordered.select("path", "range_no", "bytes", "archive", "entry").mapInArrow(unpack, "archive string, member_no long, member string, content binary, error string")
    none = [F.lit(None).cast(k).alias(c) for c, k in (("member_no", "long"), ("member", "string"), ("content", "binary"))]
    empty = found.where("begin is null").select("archive", *none, F.coalesce("error", F.lit("BadZipFile: File is not a zip file")).alias("error"))
    nowhere = F.when(F.col("range_no").isNotNull() & (F.col("to") <= F.col("from")), "BadZipFile: a member beyond its archive")
    broken = planned.withColumn("error", F.coalesce("error", nowhere)).where("error is not null").select("archive", *none, "error")
    return members.unionByName(empty).unionByName(broken)
