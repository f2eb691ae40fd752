"""The sheet parser on small sheets, good and faulty."""

import pytest
from pyspark.sql import functions as F

from terrier.operators import checks, sheets, transform
from terrier.plans import registry
from terrier.sources import folders
from terrier.streaming import drop_folder

HEAD = ["MAPPA", "L219C034500", "  4000.000"]


def parse(spark, lines, name="L219C034500.CTF", end="\r\n"):
    df = spark.createDataFrame([(name, ".CTF", end.join(lines))], "filename string, filetype string, content string")
    return sheets.parse_sheets(df).collect()[0]


def test_name_and_header(spark):
    r = parse(spark, [*HEAD, "EOF"])
    assert (r.codice_comune, r.codice_sezione_censuaria, r.codice_numero_foglio, r.numero_foglio, r.codice_allegato, r.codice_sviluppo) == ("L219", "C", "0345", "345", "0", "0")
    assert (r.mappa, r.nome_mappa, r.scala_originaria, r.scala, r.status) == ("MAPPA", "L219C034500", "4000.000", 4000.0, "ok")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_all_kinds(spark, end):
    lines = [*HEAD, "BORDO\\", "12+", "1", "0", "1.0", "2.0", "3.0", "4.0", "1", "3", "1", " 1.5", "\t2.5", "3", "4", "5", "6"]
    lines += ["TESTO", "LINEA", "1", "0", "5", "6", "SIMBOLO", "9", "0", "1", "2", "FIDUCIALE", "7", "1", "2", "3", "4", "5", "LINEA\\", "2", "0", "LINEA", "1", "2", "8", "9", "7", "6", "EOF", ""]
    r = parse(spark, lines, end=end)
    assert r.status == "ok", r.bad_text
    assert [o.kind for o in r.objects] == ["BORDO", "TESTO", "SIMBOLO", "FIDUCIALE", "LINEA", "LINEA"]
    assert [o.had_backslash for o in r.objects] == [True, False, False, False, True, False]
    df = spark.createDataFrame([("L219C034500.CTF", ".CTF", end.join(lines))], "filename string, filetype string, content string")
    border = sheets.of_kind(sheets.objects(sheets.parse_sheets(df)), "BORDO").collect()[0]
    assert border.tipo == "FABBRICATO" and border.isole == ["1"] and [(v.x, v.y) for v in border.vertici] == [("1.5", "2.5"), ("3", "4"), ("5", "6")]
    assert sheets.of_kind(sheets.objects(sheets.parse_sheets(df)), "LINEA").where("numero_vertici = 0").select(F.size("vertici")).first()[0] == 0


@pytest.mark.parametrize(
    "lines, name, status, text",
    [
        ([*HEAD, "POLIGONO", "EOF"], None, "unknown_object", "POLIGONO"),
        ([*HEAD, "TESTO", "a", "1", "2", "3", "4", "", "EOF"], None, "unknown_object", ""),
        ([*HEAD, "TESTO", "a"], None, "truncated", None),
        ([*HEAD, "LINEA", "1", "2", "8", "9"], None, "truncated", None),
        ([*HEAD, "LINEA", "1", "two", "EOF"], None, "bad_count", "LINEA"),
        ([*HEAD, "LINEA"], None, "truncated", None),
        ([*HEAD, "LINEA", "1", "2000000000", "EOF"], None, "truncated", None),
        ([*HEAD, "LINEA", "1", "9" * 30, "EOF"], None, "truncated", None),
        ([*HEAD, "BORDO", "1", "1", "0", "1", "2", "3", "4", "2000000000", "9223372036854775807", "EOF"], None, "truncated", None),
        ([*HEAD, "BORDO", "", "1", "0", "1", "2", "3", "4", "0", "0", "EOF"], None, "bad_code", "BORDO"),
        (HEAD[:2], None, "short_header", None),
        ([*HEAD, "EOF"], "L219.CTF", "bad_name", None),
        ([""], None, "short_header", None),
        (HEAD, None, "ok", None),
    ],
)
def test_status(spark, lines, name, status, text):
    r = parse(spark, lines, name or "L219C034500.CTF")
    assert (r.status, r.bad_text) == (status, text)
    assert (r.objects is None) == (status != "ok")


def test_garbage_and_null_content(spark):
    assert parse(spark, [*HEAD, "EOF", "more", "x"]).garbage == "more"
    df = spark.createDataFrame([("L219C034500.CTF", ".CTF", None)], "filename string, filetype string, content string")
    assert sheets.parse_sheets(df).first().status == "short_header"


def test_checks(spark):
    df = spark.createDataFrame([("MAP", "Z", "X", "9"), ("MAPPA", "A", "0", "U"), (None, "", "QQ", None)], "mappa string, codice_sezione_censuaria string, codice_allegato string, codice_sviluppo string")
    rows = [tuple(r)[4:] for r in checks.check_sheets(df).collect()]
    assert rows == [("value",) * 4, (None,) * 4, ("value", "len", "len", "len")]


def test_drop_folder_handles_each_file_once(spark, tmp_path):
    drop, out, ledger, done = (tmp_path / n for n in ("drop", "out", "ledger", "done"))
    drop.mkdir()
    (drop / "L219C034500.CTF").write_bytes("\r\n".join([*HEAD, "TESTO", "a", "1", "2", "3", "4", "EOF"]).encode())
    (drop / "note.txt").write_text("no sheet")
    (drop / "l219c034700.cxf").write_bytes("\r\n".join([*HEAD, "EOF"]).encode())
    drop_folder.run_once(spark, str(drop), str(out), str(ledger), archive=str(done)).awaitTermination()
    (drop / "L219C034600.CTF").write_bytes("\r\n".join([*HEAD, "EOF"]).encode())
    drop_folder.run_once(spark, str(drop), str(out), str(ledger), archive=str(done)).awaitTermination()
    got = {r.codice_foglio: len(r.objects) for r in spark.read.parquet(str(out)).collect()}
    assert got == {"L219C034500": 1, "L219C034600": 0, "L219C034700": 0}


def test_drop_folder_of_registers_and_drawings(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "a.fab").write_text("L219|A|1\nL219|B|2\n")
    (drop / "b.TIT").write_text("L219|C|3")
    (drop / "c_SC.DAT").write_bytes(b"\xff\x00")
    (drop / "d.CXF").write_text("MAPPA")
    for _ in range(2):
        drop_folder.run_registers_once(spark, str(drop), str(tmp_path / "lines"), str(tmp_path / "l1")).awaitTermination()
        drop_folder.run_drawings_once(spark, str(drop), str(tmp_path / "drawings"), str(tmp_path / "l2")).awaitTermination()
    assert sorted((r.register, r.line_no, r.value) for r in spark.read.parquet(str(tmp_path / "lines")).collect()) == [("FAB", 0, "L219|A|1"), ("FAB", 1, "L219|B|2"), ("TIT", 0, "L219|C|3")]
    assert [(r.filename, r.family, bytes(r.content)) for r in spark.read.parquet(str(tmp_path / "drawings")).collect()] == [("c_SC.DAT", "scan", b"\xff\x00")]


def test_drop_folder_takes_older_bytes_and_moves_what_it_handled(spark, tmp_path):
    drop, done = tmp_path / "drop", tmp_path / "done"
    drop.mkdir()
    (drop / "a.fab").write_bytes("città\r\nb".encode("latin-1"))
    (drop / "b.TIT").write_bytes("città".encode())
    (drop / "L219C034500.CTF").write_bytes("\r\n".join([*HEAD, "TESTO", "città", "1", "2", "3", "4", "EOF"]).encode("latin-1"))
    for _ in range(2):
        drop_folder.run_registers_once(spark, str(drop), str(tmp_path / "lines"), str(tmp_path / "l1"), max_files=1).awaitTermination()
        drop_folder.run_once(spark, str(drop), str(tmp_path / "sheets"), str(tmp_path / "l2")).awaitTermination()
    assert sorted((r.register, r.line_no, r.value) for r in spark.read.parquet(str(tmp_path / "lines")).collect()) == [("FAB", 0, "città"), ("FAB", 1, "b"), ("TIT", 0, "città")]
    assert [r.objects[0].fields[0] for r in spark.read.parquet(str(tmp_path / "sheets")).collect()] == ["città"]
    (drop / "late.TIT").write_text("x")
    assert drop_folder.move_handled(spark, str(drop), str(tmp_path / "lines"), str(done)) == ["a.fab", "b.TIT"]
    assert drop_folder.move_handled(spark, str(drop), str(tmp_path / "sheets"), str(done)) == ["L219C034500.CTF"]
    assert [p.name for p in drop.iterdir()] == ["late.TIT"] and len(list(done.iterdir())) >= 3
    assert drop_folder.move_handled(spark, str(tmp_path / "absent"), str(tmp_path / "lines"), str(done)) == []


PARAMETERS = "code string, a0 double, a1 double, a2 double, b0 double, b1 double, b2 double"


def test_whole_sheets_are_converted(spark):
    lines = [*HEAD, "BORDO", "12+", "1", "0", "1.0", "2.0", "3.0", "4.0", "1", "2", "1", "1.5", "2.5", "3", "4"]
    lines += ["TESTO", "7", "1", "0", "5", "6", "SIMBOLO", "9", "0", "1", "2", "FIDUCIALE", "7", "1", "2", "3", "4", "5", "LINEA", "2", "1", "8", "9", "EOF"]
    names = ["L219C034500", "L219C034600", "L220A000100", "L219D000100"]
    content = ["\r\n".join(lines).replace("L219C034500", n) for n in names]
    content[3] = content[3].replace("\r\n8\r\n9\r\n", "\r\n8\r\nx\r\n")
    df = spark.createDataFrame([(f"{n}.CTF", ".CTF", c) for n, c in zip(names, content, strict=True)] + [("bad.CTF", ".CTF", "")], "filename string, filetype string, content string")
    rows = [("L219", 100.0, 1.0, 0.0, 0.0, 0.0, 2.0), ("L219C034600", 0.0, 0.0, 1.0, 0.5, 1.0, 0.0), ("L219C034600", -1.0, 0.0, 1.0, 0.5, 1.0, 0.0), (None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    done, left = transform.convert_sheets(sheets.parse_sheets(df), spark.createDataFrame(rows, PARAMETERS))
    assert {(r.codice_foglio, r.filename, r.reason, r.record_no) for r in left.collect()} == {(None, "bad.CTF", "bad_name", None), ("L220A000100", "L220A000100.CTF", "no parameters", None), ("L219D000100", "L219D000100.CTF", "unreadable coordinate", 4)}
    points = {}
    for r in transform.point_rows(done).orderBy("codice_foglio", "record_no", "point_no").collect():
        points.setdefault(r.codice_foglio, []).append((r.kind, r.x, r.y))
    before = [("BORDO", 1, 2), ("BORDO", 3, 4), ("BORDO", 1.5, 2.5), ("BORDO", 3, 4), ("TESTO", 5, 6), ("SIMBOLO", 1, 2), ("FIDUCIALE", 2, 3), ("FIDUCIALE", 4, 5), ("LINEA", 8, 9)]
    assert points == {"L219C034500": [(k, 100 + x, 2 * y) for k, x, y in before], "L219C034600": [(k, y, 0.5 + x) for k, x, y in before]}
    assert done.columns == sheets.parse_sheets(df).columns
    text = sheets.of_kind(sheets.objects(done), "TESTO").where("codice_foglio = 'L219C034500'").first()
    assert (text.testo, text.dimensione, text.posizione_x) == ("7", "1", "105.000")
    none, all_ = transform.convert_sheets(sheets.parse_sheets(df.limit(0)), spark.createDataFrame([], PARAMETERS))
    assert none.count() == all_.count() == 0


def test_headers_alone(spark):
    texts = [None, "", "\n", "MAPPA", "MAPPA\r\n", "MAPPA\rX\n", "MAPPA\n X \n4000.000", "MAPPA\nX\n4000.000\n", "MAPPA\nX\n\n", "MAPPA\nX\n4000.000\nEOF\n"]
    df = spark.createDataFrame([(f"L219C0345{i:02d}.CTF", ".CTF", t) for i, t in enumerate(texts)], "filename string, filetype string, content string")
    found = sheets.headers(df)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, sheets.parse_sheets(df).select(*found.columns).collect()))


def test_vertices_of_both_kinds_in_one_pass(spark, sf_dir):
    sheet = lambda name, *objects: (name, ".CTF", "\n".join(["MAPPA", name[:11], "2000", *objects, "EOF"]))
    border = ["BORDO", "STRADA", "1", "0", "1", "2", "3", "4", "1", "3", "2", *"567890"]
    df = spark.createDataFrame([sheet("H501D076700.CTF", *border, "LINEA", "4", "2", *"1234", "TESTO", *"x0012", "LINEA", "1", "0")], "filename string, filetype string, content string")
    found = sheets.objects(sheets.parse_sheets(df))
    each = [sheets.of_kind(found, k).select("codice_foglio", "record_no", F.lit(k).alias("kind"), "vertici") for k in ("BORDO", "LINEA")]
    lists = sheets.vertex_lists(found)
    assert sorted(map(repr, lists.collect())) == sorted(map(repr, each[0].unionByName(each[1]).collect()))
    assert sorted(len(r.vertici) for r in lists.collect()) == [0, 2, 3]
    plan = registry.queries()["sheet_vertices"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_many_files_are_listed_and_moved_at_a_time(spark, tmp_path):
    names = [f"d{i % 3}/e{i % 40}/f {i}%+à.CTF" for i in range(200)]
    for n in names:
        (tmp_path / "in" / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / n).write_text(n)
    base, tracker = str(tmp_path), spark.sparkContext.statusTracker()
    seen = set(tracker.getJobIdsForGroup(None))
    assert folders.below(spark, f"{base}/in") == sorted(names)
    listings = [tracker.getStageInfo(s).numTasks for j in set(tracker.getJobIdsForGroup(None)) - seen for s in tracker.getJobInfo(j).stageIds]
    assert max(listings) <= 4 * spark.sparkContext.defaultParallelism
    (tmp_path / "done").mkdir()
    moves = [(f"{base}/in/{n}", f"{base}/done/{n.rpartition('/')[2]}") for n in names]
    folders.move_all(spark, moves)
    assert folders.below(spark, f"{base}/in") == []
    assert folders.below(spark, f"{base}/done") == sorted(n.rpartition("/")[2] for n in names)
    assert (tmp_path / "done" / "f 7%+à.CTF").read_text() == names[7]
    with pytest.raises(OSError):
        folders.move_all(spark, moves[:1])
