import io
import random
import zipfile

import pytest

from terrier.operators import census
from terrier.plans import registry
from terrier.sources import files, folders, ranged, sinks


def test_read_files(spark, tmp_path):
    (tmp_path / "a.SOG").write_text("Hello|Land|2021\nHello|Land|2022")
    (tmp_path / "b.cxf").write_text("x")
    (tmp_path / "sub").mkdir()
    rows = {r.filename: r for r in files.routed(files.admitted(files.read_files(spark, str(tmp_path)))).collect()}
    assert set(rows) == {"a.SOG", "b.cxf"}
    assert (rows["a.SOG"].filetype, rows["a.SOG"].content, rows["a.SOG"].route) == (".SOG", "Hello|Land|2021\nHello|Land|2022", "census")
    assert rows["b.cxf"].admitted and rows["b.cxf"].route == "sheet"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_files(spark, str(tmp_path / "absent")).collect()


def test_archives(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep.txt", "deep")
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z, pytest.warns(UserWarning):
        z.writestr("first.txt", "old")
        z.mkdir("sub")
        z.writestr("sub/x.FAB", "f")
        z.writestr("more.zip", inner.getvalue())
        z.writestr("first.txt", "hello again")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    members = files.expand_archives(files.read_archives(spark, str(tmp_path))).cache()
    assert members.where("error is not null").select("archive").first()[0] == "bad.zip"
    last = {r.member: bytes(r.content) for r in sinks.last_members(members).collect()}
    assert last == {"first.txt": b"hello again", "sub/x.FAB": b"f", "more.zip/deep.txt": b"deep"}
    sinks.store_members(members, str(tmp_path / "out"))
    assert {r.family for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"register", "other"}


def test_archives_with_unreadable_members(spark):
    """A broken or nested zip, an encrypted member and a damaged one cost themselves only."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("a.FAB", "first")
        z.writestr("broken.zip", b"PK no archive")
        z.writestr("hurt.TER", "to be damaged " * 20)
        z.writestr("secret.TIT", "encrypted")
        z.writestr("b.FAB", "last")
    raw = bytearray(held.getvalue())
    raw[raw.index(b"to be damaged") + 3] ^= 1  # its checksum is wrong now
    flags = raw.index(b"secret.TIT") - 30 + 6, raw.rindex(b"secret.TIT") - 46 + 8
    for at in flags:
        raw[at] |= 1  # says that it is encrypted
    df = spark.createDataFrame([("x.zip", bytes(raw)), ("y.zip", b""), ("z.zip", None)], "archive string, content binary")
    rows = {(r.archive, r.member): r for r in files.expand_archives(df).collect()}
    assert {k: (None if r.content is None else bytes(r.content), r.error is None) for k, r in rows.items()} == {
        ("x.zip", "a.FAB"): (b"first", True),
        ("x.zip", "broken.zip"): (b"PK no archive", False),
        ("x.zip", "hurt.TER"): (None, False),
        ("x.zip", "secret.TIT"): (None, False),
        ("x.zip", "b.FAB"): (b"last", True),
        ("y.zip", None): (None, False),
        ("z.zip", None): (None, False),
    }


def test_pack_archives(spark):
    rows = [("d.zip", "b.FAB", b"bb"), ("d.zip", "a.TIT", b"a"), ("d.zip", "none", b"x"), ("d.zip", "a.TIT", b"z"), ("e.zip", "n.TER", None), ("d.zip", "c.SOG", b"c" * 50)]
    df = spark.createDataFrame(rows, "archive string, filename string, content binary")
    members = sorted((r.archive, r.member_no, r.member, bytes(r.content)) for r in files.expand_archives(files.pack_archives(df, 4)).collect())
    assert members == [("d-1.zip", 0, "c.SOG", b"c" * 50), ("d.zip", 0, "a.TIT", b"a"), ("d.zip", 1, "a.TIT", b"z"), ("d.zip", 2, "b.FAB", b"bb"), ("e.zip", 0, "n.TER", b"")]
    assert files.pack_archives(df.limit(0)).count() == 0


def test_encodings(spark, tmp_path):
    (tmp_path / "new.SOG").write_bytes("citt\u00e0".encode())
    (tmp_path / "old.SOG").write_bytes("citt\u00e0".encode("latin-1"))
    assert {r.content for r in files.read_files(spark, str(tmp_path), encoding=None).collect()} == {"citt\u00e0"}
    assert [r.content for r in files.read_files(spark, str(tmp_path), "old*", encoding="ISO-8859-1").collect()] == ["citt\u00e0"]


def test_census_rows_of_wrong_length_and_values(spark):
    names = census.layout("SOG", None)
    good = {"codice_ammvo": "L219", "identificativo_soggetto": " 12 ", "tipo_soggetto": "P", "cognome": "ROSSI"}
    lines = ["|".join(good.get(n, "") for n in names), "L219", "", "|".join({**good, "identificativo_soggetto": "2.7", "tipo_soggetto": "G"}.get(n, "") for n in names)]
    df = spark.createDataFrame([("SOG", x) for x in lines], "register string, value string")
    natural = census.target(df, "ctfisica").collect()
    assert [(r.codice, r.soggetto, r.cognome) for r in natural] == [("L219", 12, "ROSSI")]
    legal = census.target(df, "ctnonfis").collect()
    assert len(legal) == 3 and all(r.soggetto is None for r in legal)


def test_store_targets(spark, tmp_path):
    df = spark.createDataFrame([("L219", "A", 1), ("L220", "B", 2)], "codice string, sezione string, n int")
    sinks.store_targets({"t": df}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "t")).where("codice = 'L220'").count() == 1
    sinks.store_registers({"TERRENI": df}, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).select("register").distinct().first()[0] == "TERRENI"


def test_layouts():
    assert census.layout("FAB", "1")[:6] == ["codice_ammvo", "sezione", "identificativo_immobile", "tipo_immobile", "progressivo", "tipo_record"]
    assert {t: len(census.fields(t)) for t in census.TARGETS} == {"cuarcuiu": 44, "cuindiri": 11, "cuidenti": 11, "curiserv": 7, "ctpartic": 42, "ctdeduzi": 6, "ctriserv": 7, "ctporzio": 13, "cttitola": 32, "ctfisica": 11, "ctnonfis": 7}


def test_ranged_archives_equal_whole_ones(spark, tmp_path, monkeypatch):
    """Archives larger than a chunk, nested, damaged, large-form, empty and none: the same members as when each is one cell."""
    rng = random.Random(4)
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep.txt", "deep\n\nlines")
        z.writestr("more.bin", rng.randbytes(5000))
    folder = tmp_path / "in"
    folder.mkdir()
    with zipfile.ZipFile(folder / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("sub")
        for i in range(60):
            z.writestr(f"sub/{i}.bin", rng.randbytes(rng.choice([0, 10, 100_000])), rng.choice([zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2]))
        z.writestr("text.FAB", "a|b\n" * 100_000)
        z.writestr("huge.bin", rng.randbytes(2_500_000))
        z.writestr("inner.zip", inner.getvalue())
        z.writestr("broken.zip", b"PK no archive")
    raw = bytearray((folder / "big.zip").read_bytes())
    raw[raw.index(b"huge.bin") + 1000] ^= 1
    (folder / "hurt.zip").write_bytes(bytes(raw))
    (folder / "led.zip").write_bytes(b"leading bytes\n" + inner.getvalue() + b"\n")
    (folder / "cut.zip").write_bytes(bytes(raw[:-10]))
    (folder / "none.zip").write_bytes(b"no archive")
    (folder / "empty.zip").write_bytes(b"")
    with zipfile.ZipFile(folder / "nothing.zip", "w"):
        pass
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    with zipfile.ZipFile(folder / "large.zip", "w") as z:
        for i in range(5):
            with z.open(f"{i}.txt", "w", force_zip64=True) as f:
                f.write(b"x" * i)
    monkeypatch.undo()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        found = ranged.expand_ranged(spark, str(folder), str(tmp_path / "work"))
        got = found.collect()
        assert spark.read.parquet(str(tmp_path / "work/chunks")).select("block").distinct().count() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = files.expand_archives(files.read_archives(spark, str(folder))).collect()
    rows = lambda some: sorted((r.archive, r.member or "", r.content is None, bytes(r.content or b""), r.error is None) for r in some)
    assert rows(got) == rows(whole)
    order = lambda some: [(r.archive, r.member) for r in sorted(some, key=lambda r: (r.archive, r.member_no if r.member_no is not None else -1))]
    assert order(got) == order(whole)
    assert sorted((r.archive, r.member or "") for r in got if r.error) == [("big.zip", "broken.zip"), ("cut.zip", ""), ("hurt.zip", "broken.zip"), ("hurt.zip", "huge.bin"), ("none.zip", "")]


def test_ranged_archives_by_streams_of_members(spark, sf_dir, monkeypatch):
    """Neither a group for each member nor a rename for each archive: both are few rows, but grow with the input."""

    def moved(*_):
        raise AssertionError("renamed by the driver")

    monkeypatch.setattr(folders, "move", moved)
    found = registry.queries()["archive_members_ranged"](spark, sf_dir)
    assert "FlatMapGroups" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where("archive = 'z0.zip'").count() > 2
