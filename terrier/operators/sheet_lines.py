"""Map sheets read by line, however long: the same records and verdicts as parse_sheets(), without a row for a whole sheet.

Lines stand in chunks, rows of a bounded number of lines that follow each other. Each marker line knows the line right behind its
record. Which markers begin records (and don't stand inside of one) is then a question of what can be reached from the first line
behind the header. Within a chunk each marker is followed to the place where it leaves the chunk; between chunks pointer doubling
answers: a table of jumps over 1, 2, 4, ... chunks meets itself, and the places reached so far meet it once each time. That takes
as many rounds as the largest number of a file's chunks has bits, over a few rows for each chunk. Chunks are then walked from the
places where they are entered, and records that end in another chunk are put together from the pieces of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.functions.scalars import strip
from terrier.operators.sheets import FIELDS, base_name, decode_name
from terrier.sources.files import BLOCKS, CHUNK, with_type

#: Lines of a record without its variable part, and at what distance its counts stand: of islands (one line each) and of vertices (two).
LENGTHS = {"BORDO": 10, "TESTO": 6, "SIMBOLO": 5, "FIDUCIALE": 7, "LINEA": 3}
COUNTS = {"BORDO": (8, 9), "LINEA": (None, 2)}
FIRST = 3
#: How far behind a marker lines are looked at.
AHEAD = 9
#: More than any sheet has lines.
_BEYOND = 1 << 40
_PLACE = ["filename", "n"]


def _kept(df: DataFrame, work: str, name: str) -> DataFrame:
    """Written and read again, so that rounds don't pile up and a lost executor costs one round."""
    df.write.mode("overwrite").parquet(f"{work}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{work}/{name}")


def _count(c: Column) -> Column:
    """The number in a line; beyond all bounds for one that a long can't hold, null for none."""
    return F.when(c.rlike("^[+-]?[0-9]+$"), F.least(F.lit(_BEYOND), F.greatest(F.lit(0).cast("long"), F.coalesce(c.try_cast("long"), F.lit(_BEYOND)))))


def _tails(chunks: DataFrame) -> DataFrame:
    """(filename, n, tail): the AHEAD lines behind each chunk, from the first lines of those that follow it."""
    at = F.col("n").alias("at")
    heads = chunks.where("n > 0").select("filename", at, F.posexplode("head").alias("i", "x")).select("filename", (F.col("at") + F.col("i")).alias("at"), "x")
    behind = F.sequence(F.col("n") + F.col("size"), F.col("n") + F.col("size") + AHEAD - 1)
    found = chunks.select(*_PLACE, F.explode(behind).alias("at")).join(heads, ["filename", "at"])
    return found.groupBy(*_PLACE).agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("t")).select(*_PLACE, F.transform("t", lambda r: r["x"]).alias("tail"))


def marked(chunks: DataFrame) -> DataFrame:
    """(filename, n, size, marks): for each chunk the lines that look like markers, as (p, kind, had_backslash, next, no_code): next is the line behind the record, null where there is none or a count is none."""
    lines = F.concat("l", F.coalesce("tail", F.array().cast("array<string>"))).alias("x")
    tails = _tails(chunks)
    # a few short lines for each chunk: sent to all tasks where chunks aren't too many, so that texts stay where they are
    tails = F.broadcast(tails) if chunks.count() <= BLOCKS else tails
    seen = chunks.join(tails, _PLACE, "left").select(*_PLACE, "size", "l", lines)

    def told(m: Column) -> Column:
        i, length = m["i"], F.lit(None).cast("long")
        for kind, fixed in LENGTHS.items():
            islands, vertices = COUNTS.get(kind, (None, None))
            total = F.lit(fixed).cast("long")
            total = total + _count(F.get("x", i + islands)) if islands else total
            total = total + 2 * _count(F.get("x", i + vertices)) if vertices else total
            length = F.when(m["kind"] == kind, total).otherwise(length)
        p = F.col("n") + i
        no_code = (m["kind"] == "BORDO") & (F.get("x", i + 1) == "")
        return F.struct(p.alias("p"), m["kind"].alias("kind"), (F.get("x", i) != m["kind"]).alias("had_backslash"), (p + length).alias("next"), no_code.alias("no_code"))

    named = F.transform("l", lambda x, i: F.struct(i.alias("i"), F.rtrim(x, F.lit("\\")).alias("kind")))
    markers = F.filter(named, lambda m: m["kind"].isin(*FIELDS, "EOF") & (F.col("n") + m["i"] >= FIRST))
    return seen.select(*_PLACE, "size", F.transform(markers, told).alias("marks"))


def _places(marks: pa.ListArray) -> Iterator[tuple[list[int], list[int]]]:
    """For each chunk the places of its markers, and what lies behind their records (-1: nothing)."""
    flat, bounds = marks.flatten(), marks.offsets.to_pylist()
    p, behind = flat.field("p").to_pylist(), flat.field("next").fill_null(-1).to_pylist()
    for a, b in zip(bounds, bounds[1:]):
        yield p[a - bounds[0] : b - bounds[0]], behind[a - bounds[0] : b - bounds[0]]


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each place of a chunk leads to outside of its markers, and over how many records; of a first chunk only for the first place behind the header, as nothing else leads into it."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [])
        for filename, n, (p, behind) in zip(batch.column("filename").to_pylist(), batch.column("n").to_pylist(), _places(batch.column("marks"))):
            ends: dict[int, tuple[int, int]] = {}
            for place, to in zip(reversed(p), reversed(behind)):
                end, hops = ends.get(to, (to, 0))
                ends[place] = end, hops + 1
            for place in (p if n else [x for x in p if x == FIRST]):
                for column, value in zip(out, (filename, n, place, *ends[place])):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if i == 0 else pa.int64()) for i, x in enumerate(out)], ["filename", "n", "p", "to", "hops"])


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """With picks: which markers of a chunk begin records, from the place where it is entered."""
    for batch in batches:
        picks = []
        for entry, (p, behind) in zip(batch.column("entry").to_pylist(), _places(batch.column("marks"))):
            at, found = {place: i for i, place in enumerate(p)}, []
            i = at.get(entry)
            while i is not None:
                found.append(i)
                i = at.get(behind[i])
            picks.append(found)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(picks, pa.list_(pa.int32()))], [*batch.schema.names, "picks"])


def entered(marks: DataFrame, work: str) -> DataFrame:
    """(filename, n, entry, record_no): the chunks of marked() in which records begin, the first of them, and its number in the file."""
    ways = _kept(marks.select(*_PLACE, "size", "marks").mapInArrow(_left, "filename string, n long, p long, to long, hops long").where("p is not null"), work, "ways")
    # what leaves a chunk and leads to a marker of another; only the first places and those can be where a chunk is entered
    first = ways.where(F.col("p") == FIRST)
    ways = _kept(first.unionByName(ways.where(F.col("p") != FIRST).join(ways.select("filename", F.col("to").alias("p")).distinct(), ["filename", "p"], "left_semi")), work, "entries")
    jumps = _kept(ways.join(ways.select("filename", F.col("p").alias("to")), ["filename", "to"], "left_semi").select("filename", "p", "to", "hops"), work, "jumps-0")
    found = _kept(ways.where(F.col("p") == FIRST).select("filename", "p", F.lit(0).cast("long").alias("record_no")), work, "found-0")
    step = 0
    while True:
        step += 1
        further = found.join(jumps, ["filename", "p"]).select("filename", F.col("to").alias("p"), (F.col("record_no") + F.col("hops")).alias("record_no"))
        further = _kept(further, work, f"further-{step}")
        if further.limit(1).count() == 0:
            return found.join(ways.select(*_PLACE, "p"), ["filename", "p"]).select(*_PLACE, F.col("p").alias("entry"), "record_no")
        found = _kept(found.unionByName(further), work, f"found-{step}")
        second = jumps.select("filename", F.col("p").alias("to"), F.col("to").alias("beyond"), F.col("hops").alias("more"))
        jumps = _kept(jumps.join(second, ["filename", "to"]).select("filename", "p", F.col("beyond").alias("to"), (F.col("hops") + F.col("more")).alias("hops")), work, f"jumps-{step}")


def recorded(marks: DataFrame, work: str) -> DataFrame:
    """(filename, n, size, records): of the chunks in which records begin those of their marks() that do, with record_no."""
    held = marks.join(entered(marks, work), _PLACE)
    schema = "filename string, n long, size long, marks {}, entry long, record_no long, picks array<int>".format(marks.schema["marks"].dataType.simpleString())
    walked = held.select(*_PLACE, "size", "marks", "entry", "record_no").mapInArrow(_walked, schema)

    def record(i: Column, k: Column) -> Column:
        m = F.get("marks", i)
        return F.struct(*[m[c].alias(c) for c in ("p", "kind", "had_backslash", "next", "no_code")], (F.col("record_no") + k).cast("int").alias("record_no"))

    return walked.select(*_PLACE, "size", F.transform("picks", record).alias("records"))


def parse_lines(lines: DataFrame, work: str, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Sheets and objects of lines(filename, line_no, value), which are put in chunks first: see parse_chunks()."""
    rows = lines.select("filename", F.col("line_no").cast("long").alias("n"), "value")
    held = rows.groupBy("filename", F.expr(f"n div {chunk}")).agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("r"))
    return parse_chunks(held.select("filename", F.get("r", F.lit(0))["n"].alias("line_no"), F.transform("r", lambda r: r["value"]).alias("lines")), work)


def parse_chunks(chunks: DataFrame, work: str) -> tuple[DataFrame, DataFrame]:
    """Sheets and objects of chunks(filename, line_no, lines): some lines of a file that follow each other, the number of the first one, and so on.

    Sheets: a row for each file with the parts of its name, mappa, nome_mappa, scala_originaria, status, bad_line, bad_text and
    garbage, as parse_sheets() has them. Objects: (codice_foglio, record_no, kind, had_backslash, fields) of sheets that are ok.
    filename may be a path, where names alone don't tell files apart. work: a folder for what rounds leave. Files without lines have no row.
    """
    held = chunks.select("filename", F.col("line_no").cast("long").alias("n"), F.transform("lines", strip).alias("l"))
    chunks = _kept(held.select(*_PLACE, F.size("l").cast("long").alias("size"), F.slice("l", 1, AHEAD).alias("head"), "l"), work, "chunks")
    records = _kept(recorded(_kept(marked(chunks), work, "marks"), work), work, "records")

    first = [F.max(F.get("head", (F.lit(i) - F.col("n")).cast("int"))).alias(c) for i, c in enumerate(("mappa", "nome_mappa", "scala_originaria"))]
    heads = chunks.groupBy("filename").agg(F.sum("size").alias("size"), *first)
    ends = records.select("filename", F.element_at("records", -1).alias("r"), F.get(F.filter("records", lambda r: r["no_code"]), F.lit(0))["p"].alias("p"))
    last = ends.groupBy("filename").agg(F.max_by(F.struct("r.p", "r.kind", "r.next"), "r.record_no").alias("last"), F.min("p").alias("no_code"))
    # where the walk ends: at EOF, at a count that is none, behind the last line, or at a line that is no marker
    at = heads.join(last, "filename", "left").withColumn("kind", F.col("last.kind")).withColumn("next", F.when(F.col("last").isNull(), F.lit(FIRST).cast("long")).otherwise(F.col("last.next")))
    eof = F.when(F.col("kind") == "EOF", F.col("last.p"))
    bad = F.when((F.col("kind") != "EOF") & F.col("next").isNull(), F.col("last.p"))
    beyond_bad = F.col("bad") + F.when(F.col("kind") == "LINEA", 3).otherwise(10) > F.col("size")
    status = (
        F.when(~F.col("name_ok"), "bad_name")
        .when(F.col("size") < FIRST, "short_header")
        .when(F.col("eof").isNull() & (F.coalesce(F.col("next"), F.lit(0)) > F.col("size")), "truncated")
        .when(F.col("bad").isNotNull(), F.when(beyond_bad, "truncated").otherwise("bad_count"))
        .when(F.col("eof").isNull() & (F.col("next") < F.col("size")), "unknown_object")
        .when(F.col("no_code").isNotNull(), "bad_code")
        .otherwise("ok")
    )
    place = F.when(F.col("status") == "truncated", F.col("size")).when(F.col("status") == "bad_count", F.col("bad")).when(F.col("status") == "unknown_object", F.col("next")).when(F.col("status") == "bad_code", F.col("no_code"))
    # of files that are told apart by their path, the last part is the name
    short = with_type(at.withColumn("_path", F.col("filename")).withColumn("filename", F.regexp_extract("filename", "([^/]*)$", 1)))
    named = base_name(short).withColumn("filename", F.col("_path")).drop("_path").withColumns(decode_name("name")).withColumn("eof", eof).withColumn("bad", bad)
    told = _kept(named.withColumn("status", status).withColumn("bad_line", place), work, "told")
    # lines that verdicts are about; most sheets end with EOF, and nothing behind it
    asked = told.select("filename", F.explode(F.array("bad_line", F.when(F.col("eof") + 1 < F.col("size"), F.col("eof") + 1))).alias("at")).where("at is not null").distinct()
    inside = (F.col("at") >= F.col("n")) & (F.col("at") < F.col("n") + F.col("size"))
    found = chunks.join(asked, "filename").where(inside).select("filename", "at", F.get("l", (F.col("at") - F.col("n")).cast("int")).alias("x"))
    found = _kept(found, work, "asked")
    text = found.select("filename", F.col("at").alias("bad_line"), F.col("x").alias("bad_text"))
    behind = found.select("filename", (F.col("at") - 1).alias("eof"), F.col("x").alias("garbage"))
    told = told.join(text, ["filename", "bad_line"], "left").join(behind, ["filename", "eof"], "left")
    names = list(decode_name("name"))
    sheets = _kept(told.select("filename", *names, "mappa", "nome_mappa", "scala_originaria", "status", "bad_line", "bad_text", "garbage"), work, "sheets")
    return sheets, _objects(chunks, records, sheets)


def _objects(chunks: DataFrame, records: DataFrame, sheets: DataFrame) -> DataFrame:
    """(codice_foglio, record_no, kind, had_backslash, fields) of sheets that are ok: records within a chunk as they are, the others from their pieces."""
    good = records.join(sheets.where("status = 'ok'").select("filename", "codice_foglio"), "filename")
    end = F.col("n") + F.col("size")

    def fields(r: Column) -> Column:
        """Of the lines of a record those that stand in the chunk."""
        start = F.greatest(r["p"] + 1, F.col("n"))
        return F.slice("l", (start - F.col("n") + 1).cast("int"), F.greatest(F.lit(0), F.least(r["next"], end) - start).cast("int"))

    told = ["record_no", "kind", "had_backslash"]
    whole = F.filter("records", lambda r: (r["kind"] != "EOF") & (r["next"] <= end))
    within = good.withColumn("records", whole).join(chunks.select(*_PLACE, "l"), _PLACE)
    within = within.select("codice_foglio", F.explode(F.transform("records", lambda r: F.struct(*[r[c].alias(c) for c in told], fields(r).alias("fields"))))).select("codice_foglio", "col.*")

    # at most one record leaves a chunk; it is the last one that began there, and goes on in each chunk that begins before its end
    leaving = good.select(*_PLACE, "size", "codice_foglio", F.element_at("records", -1).alias("r")).where((F.col("r.kind") != "EOF") & (F.col("r.next") > end))
    along = chunks.select(*_PLACE, "size").join(leaving.select(*_PLACE, F.struct("codice_foglio", "r").alias("own")), _PLACE, "left")
    before = F.last("own", ignorenulls=True).over(Window.partitionBy("filename").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    parted = along.withColumn("before", before).select(*_PLACE, "size", F.explode(F.array("own", "before")).alias("o")).where((F.col("o.r.p") >= F.col("n")) | (F.col("o.r.next") > F.col("n")))
    pieces = parted.join(chunks.select(*_PLACE, "l"), _PLACE).select("filename", "n", "o.codice_foglio", *[F.col(f"o.r.{c}") for c in told], fields(F.col("o.r")).alias("piece"))
    joined = pieces.groupBy("filename", "codice_foglio", *told).agg(F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("pieces"))
    return within.unionByName(joined.select("codice_foglio", *told, F.flatten(F.transform("pieces", lambda r: r["piece"])).alias("fields")))
