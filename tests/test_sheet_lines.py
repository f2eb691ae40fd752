"""Sheets read by line against the same sheets parsed as a whole."""

import pytest

from terrier.operators import sheet_lines, sheets
from terrier.plans import testbed
from terrier.sources import files as sources
from test_sheets import HEAD

CASES = [
    [*HEAD, "BORDO\\", "12+", "1", "0", "1.0", "2.0", "3.0", "4.0", "1", "3", "1", " 1.5", "\t2.5", "3", "4", "5", "6", "TESTO", "LINEA", "1", "0", "5", "6", "LINEA\\", "2", "0", "LINEA", "1", "2", "8", "9", "7", "6", "EOF", ""],
    [*HEAD, "TESTO", "EOF", "BORDO", "TESTO", "LINEA", "SIMBOLO", "SIMBOLO", "LINEA", "TESTO", "EOF", "2", "FIDUCIALE", "EOF", "1", "2", "3", "4", "5", "EOF", "more", "x"],
    [*HEAD, "POLIGONO", "EOF"],
    [*HEAD, "TESTO", "a", "1", "2", "3", "4", "", "EOF"],
    [*HEAD, "TESTO", "a"],
    [*HEAD, "LINEA", "1", "2", "8", "9"],
    [*HEAD, "LINEA", "1", "two", "EOF"],
    [*HEAD, "LINEA"],
    [*HEAD, "LINEA", "1", "2000000000", "EOF"],
    [*HEAD, "LINEA", "1", "9" * 30, "EOF"],
    [*HEAD, "LINEA", "1", "-5", "EOF"],
    [*HEAD, "BORDO", "1", "1", "0", "1", "2", "3", "4", "2000000000", "9223372036854775807", "EOF"],
    [*HEAD, "BORDO", "", "1", "0", "1", "2", "3", "4", "0", "0", "EOF"],
    [*HEAD, "BORDO", "", "1", "0", "1", "2", "3", "4", "0", "x", "EOF"],
    [*HEAD, "TESTO", "a", "1", "2", "3", "4"],
    HEAD[:2],
    [*HEAD, "EOF"],
    HEAD,
    [""],
]
STATUS = ["codice_foglio", "codice_comune", "numero_foglio", "mappa", "nome_mappa", "scala_originaria", "status", "bad_line", "bad_text", "garbage"]


def both(spark, files, work):
    whole = sheets.parse_sheets(files)
    lines = files.selectExpr("filename", "content").select("filename", sheets.split_lines("content").alias("l")).selectExpr("filename", "posexplode(l) as (line_no, value)")
    return whole, *sheet_lines.parse_lines(lines, work)


def rows(df, columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


@pytest.mark.parametrize("name", ["L219C{:04d}00.CTF", "short{}.CTF"])
def test_lines_equal_whole_sheets(spark, tmp_path, name):
    files = spark.createDataFrame([(name.format(i), ".CTF", "\r\n".join(c)) for i, c in enumerate(CASES)], "filename string, filetype string, content string")
    whole, found, objects = both(spark, files, str(tmp_path))
    empty = name.format(len(CASES) - 1)  # a file without lines has no row here
    assert rows(found.where(f"filename <> '{empty}'"), STATUS) == rows(whole.where(f"filename <> '{empty}'"), STATUS)
    columns = ["codice_foglio", "record_no", "kind", "had_backslash", "fields"]
    assert rows(objects, columns) == rows(sheets.objects(whole), columns)


@pytest.mark.parametrize("faults", [False, True])
def test_lines_equal_whole_sheets_of_the_tables(spark, sf_dir, tmp_path, faults):
    whole, found, objects = both(spark, testbed.render_sheets(spark, sf_dir, faults), str(tmp_path))
    assert rows(found, STATUS) == rows(whole, STATUS)
    columns = ["codice_foglio", "record_no", "kind", "had_backslash", "fields"]
    assert rows(objects, columns) == rows(sheets.objects(whole), columns)


@pytest.mark.parametrize("chunk", [1, 5, 64])
def test_chunks_of_any_size(spark, tmp_path, chunk):
    """Records that go on over many chunks, and jumps over more of them than one round takes."""
    long = [*HEAD, *["TESTO", "LINEA", "1", "2", "TESTO", "4"] * 40, "LINEA", "1", "90", *["LINEA", "1"] * 90, "BORDO", "a", "1", "0", "1", "2", "3", "4", "30", "40", *["7"] * 110, "EOF", "more"]
    cases = [*CASES[:-1], long, [*long[:-3], "POLIGONO"]]
    files = spark.createDataFrame([(f"L219C{i:04d}00.CTF", ".CTF", "\r\n".join(c)) for i, c in enumerate(cases)], "filename string, filetype string, content string")
    lines = files.select("filename", sheets.split_lines("content").alias("l")).selectExpr("filename", "posexplode(l) as (line_no, value)")
    found, objects = sheet_lines.parse_lines(lines, str(tmp_path), chunk)
    whole = sheets.parse_sheets(files)
    assert rows(found, STATUS) == rows(whole, STATUS)
    columns = ["codice_foglio", "record_no", "kind", "had_backslash", "fields"]
    assert rows(objects, columns) == rows(sheets.objects(whole), columns)


@pytest.mark.parametrize("most", [1, 7, sources.CHUNK])
def test_chunks_of_files_have_the_lines_of_files(spark, tmp_path, most):
    texts = {"a.SOG": "".join(f"line {i} of a, città\r\n" for i in range(300)).encode("latin-1"), "b.SOG": "\n".join(f"line {i} of b, città" for i in range(200)).encode(), "c.SOG": b"", "d.SOG": b"\n\nx"}
    (tmp_path / "in").mkdir()
    for name, text in texts.items():
        (tmp_path / "in" / name).write_bytes(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        read = sources.read_lines(spark, str(tmp_path / "in"))
        read.write.parquet(str(tmp_path / "lines"))
        sources.chunked(read, most).write.parquet(str(tmp_path / "chunks"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    chunks = sources.numbered_chunks(spark.read.parquet(str(tmp_path / "chunks")))
    assert chunks.where(f"size(lines) > {most}").count() == 0
    told = chunks.selectExpr("filename", "line_no", "posexplode(lines) as (i, value)").selectExpr("filename", "line_no + i as line_no", "value")
    assert rows(told, ["filename", "line_no", "value"]) == rows(sources.numbered(spark.read.parquet(str(tmp_path / "lines"))), ["filename", "line_no", "value"])


def test_many_sheets_are_written_by_many_tasks(spark, tmp_path):
    made = spark.range(4 * testbed.SHEETS_PER_TASK).selectExpr("concat('f', id) as filename", "'x' as value")
    seen = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    testbed.place_parts(made, [], str(tmp_path / "out"), per_task=testbed.SHEETS_PER_TASK)
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in set(tracker.getJobIdsForGroup(None)) - seen for s in tracker.getJobInfo(j).stageIds]
    assert max(tasks) > 4
