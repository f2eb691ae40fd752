"""Declared keys, one-pass registers, deliveries and buckets on small inputs, odd ones among them."""

import pytest
from pyspark.sql import functions as F

from terrier.operators import census, checks, keys, links, registers
from terrier.plans import registry, testbed
from terrier.sources import files, folders, sinks

TITLE = "codice string, sezione string, soggetto int, tipo_sog string, immobile int, numeratore int, denominato int, identifica int"
NATURAL = "codice string, sezione string, soggetto int, tipo_sog string, cognome string, nome string"
LEGAL = "codice string, sezione string, soggetto int, tipo_sog string, denominaz string"


def test_unreadable_ids_own_nothing(spark):
    titles = spark.createDataFrame([("H501", "A", None, "P", i, 1, 1, i) for i in range(100)] + [("H501", "A", 7, "P", 1, 1, 2, 1000)], TITLE)
    natural = spark.createDataFrame([("H501", "A", None, "P", "x", str(i)) for i in range(100)] + [("H501", "A", 7, "P", "Rossi", "Ada")], NATURAL)
    legal = spark.createDataFrame([], LEGAL)
    assert [(r.soggetto, r.subject) for r in links.owners(titles, natural, legal).collect()] == [(7, "Rossi Ada")]
    left = links.unmatched_titles(titles, natural, legal).groupBy("reason").count().collect()
    assert [tuple(r) for r in left] == [("no soggetto", 100)]
    nobody = links.unmatched_titles(titles, natural.limit(0), legal).groupBy("reason").count().orderBy("reason").collect()
    assert [tuple(r) for r in nobody] == [("no soggetto", 100), ("no such subject", 1)]
    assert links.owners(titles.limit(0), natural, legal).count() == 0


def test_unreadable_sheets_are_no_parcel(spark):
    units = spark.createDataFrame([("H501", "A", 1, 1, "x12", "5", None), ("H501", "A", 2, 1, "012", "5", None), ("H501", "A", 3, 1, "12", "5", 1), ("H501", None, 4, 1, "12", "5", None)], "codice string, sezione string, immobile int, progressiv int, foglio string, numero string, denominato int")
    parcels = spark.createDataFrame([("H501", "A", 10, None, "5", None), ("H501", "A", 11, None, "5", None), ("H501", "A", 12, 12, "5", None), ("H501", "A", None, 12, "5", 1), ("H501", None, 13, 12, "5", None)], "codice string, sezione string, immobile int, foglio int, numero string, denominato int")
    found = {r.immobile: r.terreno_id is not None for r in links.units_to_land(units, parcels).collect()}
    assert found == {1: False, 2: True, 3: False, 4: False}
    assert {(r.immobile, r.reason) for r in links.unmatched_units(units, parcels).collect()} == {(1, "no foglio"), (3, "no such parcel"), (4, "no sezione")}


def test_links_come_parcel_by_parcel(spark, monkeypatch):
    """Of all pairs of a key, a parcel's stand in one run of rows, and tasks follow from the number of parcels."""
    units = spark.createDataFrame([("H501", "A", i, 1, "12", str(n), None) for n in range(41) for i in range(30)], "codice string, sezione string, immobile int, progressiv int, foglio string, numero string, denominato int")
    parcels = spark.createDataFrame([("H501", "A", 100 * n + i, 12, str(n), None) for n in range(40) for i in range(25)], "codice string, sezione string, immobile int, foglio int, numero string, denominato int")
    monkeypatch.setattr(links, "PARCELS_PER_TASK", 50, raising=False)
    for heavy_rows in (10, 1_000_000):
        rows = links.units_to_land(units, parcels, heavy_rows).withColumn("task", F.spark_partition_id()).collect()
        assert len(rows) == 40 * 30 * 25 + 30 and len({(r.numero, r.immobile, r.terreno_id) for r in rows}) == len(rows)
        assert {r.numero for r in rows if r.terreno_id is None} == {"40"}
        runs = sum(a.terreno_id != b.terreno_id for a, b in zip(rows, rows[1:], strict=False)) + 1
        assert runs <= 40 * 25 * (3 if heavy_rows == 10 else 1) + 4
        assert len({r.task for r in rows if r.terreno_id}) > 10


@pytest.mark.parametrize("optional", [(), ("part",)])
def test_heavy_keys_are_dealt_out(spark, optional):
    key = keys.Key(("a", "b"), optional)
    rows = [("x", 1, None, i) for i in range(2000)] + [("y", i % 50, "p", i) for i in range(500)] + [(None, 1, None, 1), ("x", None, None, 2)]
    left = spark.createDataFrame(rows, "a string, b int, part string, n int")
    right = spark.createDataFrame([("x", 1, None, "one"), ("x", 1, None, "two"), ("y", 3, "p", "three"), ("y", 4, "q", "four"), (None, 1, None, "no")], "a string, b int, part string, what string")
    right = right if optional else right.drop("part")
    heavy = keys.heavy_keys(left, key, 100)
    assert [(r.a, r.b, r._salts) for r in heavy.collect()] == [("x", 1, 20)]
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain, dealt = (keys.join(left, right, key, how, h) for h in (None, heavy))
        assert plain.columns == dealt.columns and plain.exceptAll(dealt).count() == 0 == dealt.exceptAll(plain).count()
    assert keys.join(left, right, key, "inner", heavy).count() == 4000 + (10 if optional else 20)
    # rows of the heavy key come out of many partitions
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = keys.join(left, right, key, "inner", heavy).where("a = 'x'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in sizes) < 2000


def test_heavy_keys_are_bounded(spark):
    left = spark.createDataFrame([(str(i % 40),) for i in range(4000)], "a string")
    key = keys.Key(("a",))
    assert keys.heavy_keys(left, key, 10, most=5) is None  # forty keys of a hundred rows: none is heavier than the others
    assert keys.heavy_keys(left, key, 10, most=40).count() == 40


def line(register, record_type, **values):
    names = census.layout(register, record_type)
    return "|".join(record_type if n == "tipo_record" else values.get(n, "v") for n in names)


def test_lines_are_split_once(spark, tmp_path):
    full = line("TER", "1", codice_ammvo="H501", identificativo_immobile="12", annotazione='"a|b ""c"""')
    rows = [("TER", full), ("TER", full.rsplit("|", 1)[0]), ("TER", full + "|x"), ("TER", line("TER", "1").replace("|1|", "|9|", 1)), ("TER", line("TER", "1").replace("|1|", "| |", 1)), ("TER", ""), ("TER", None), ("SUP", "a|b"), (None, "x"), ("SOG", line("SOG", None, tipo_soggetto="P")), ("FAB", line("FAB", "2"))]
    lines = spark.createDataFrame([(r, v, i) for i, (r, v) in enumerate(rows)], "register string, value string, line_no int")
    seen = registers.store_split(lines, str(tmp_path / "split"))
    assert (seen["lines"], seen["rejects"], seen["TER"], seen["TER reject"]) == (11, 8, 7, 6)
    rejects = {r.line_no: (r.reason, r.value) for r in registers.rejects(spark, str(tmp_path / "split")).collect()}
    assert {k: v[0] for k, v in rejects.items()} == {1: "too few fields", 2: "too many fields", 3: "unknown type", 4: "no type", 5: "no type", 6: "no type", 7: "unknown register", 8: "unknown register"}
    assert rejects[1][1] == rows[1][1]
    made = registers.targets(spark, str(tmp_path / "split"))
    assert {t: df.count() for t, df in made.items() if df.count()} == {"ctpartic": 1, "ctfisica": 1}
    assert [(r.immobile, r.annotazion) for r in made["ctpartic"].collect()] == [(12, 'a|b "c"')]
    assert registers.records(spark, str(tmp_path / "split"), "FAB-2").count() == 1
    # each target reads its own folder only
    assert "PartitionFilters: [isnotnull(record" in made["ctpartic"]._jdf.queryExecution().toString()


def test_records_are_written_unsorted(spark, tmp_path):
    """Lines go to the files of their kind as they come, without a sort; fields are split again where one kind is read."""
    store = spark._jsparkSession.sharedState().statusStore()
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    lines = spark.createDataFrame([(r, line(r, t), i * 100 + j) for j, (r, t) in enumerate(registers.RECORDS.values()) for i in range(20)] + [("TER", "a|b", 0)], "register string, value string, line_no int")
    registers.store_split(lines, str(tmp_path / "split"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    plans = [p for p in (e.physicalPlanDescription() for e in (store.executionsList().apply(i) for i in range(store.executionsList().size()))) if str(tmp_path / "split") in p and "InsertIntoHadoopFsRelationCommand" in p]
    assert plans and not any("Sort" in p for p in plans)
    assert spark.conf.get(key) == before
    assert "fields" not in spark.read.parquet(str(tmp_path / "split")).columns
    assert {n: registers.records(spark, str(tmp_path / "split"), n).count() for n in registers.RECORDS} == dict.fromkeys(registers.RECORDS, 20)


def test_rejects_need_no_store(spark, sf_dir):
    """register_rejects tells rejects from lines, and reads no records of other kinds back."""
    plan = registry.queries()["register_rejects"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "record" not in plan.replace("record_", "")


def test_split_fields(spark):
    texts = ["a|b", "", "|", 'x|"a|b"|y', '"a""b"|c', '"open|b', 'a"b|c', '""|x', '"a"b|c', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.f for r in df.select("i", files.split_fields("t").alias("f")).orderBy("i").collect()]
    assert got == [["a", "b"], [""], ["", ""], ["x", "a|b", "y"], ['a"b', "c"], ['"open', "b"], ['a"b', "c"], ["", "x"], ['"a"b', "c"], None]


def test_missing_fields_of_all_kinds(spark):
    rows = [(n, ["1"] * len(census.layout(*o)), i) for i, (n, o) in enumerate(registers.RECORDS.items())]
    df = spark.createDataFrame([*rows, ("reject", [], 99), ("SOG", ["1", "", " ", "P"], 100), ("SOG", [], 101)], "record string, fields array<string>, i int")
    got = {r.i: r.m for r in df.select("i", registers.missing().alias("m")).collect()}
    assert all(not got[i] for i in (*range(len(rows)), 99))
    assert got[100] == ["identificativo_soggetto", "codice_fiscale"] and got[101] == ["codice_ammvo", "identificativo_soggetto", "tipo_soggetto", "codice_fiscale"]
    assert {n: len(census.layout(*o)) - len(census.optional(*o)) for n, o in registers.RECORDS.items()}["TIT"] == 26
    assert checks.missing_of(F.array(F.lit("")), ["a"], frozenset({"a"})) is not None


def test_line_numbers_survive_splitting(spark, tmp_path):
    texts = {"a.SOG": "".join(f"line {i} of a, città\r\n" for i in range(3000)).encode("latin-1"), "b.SOG": "\n".join(f"line {i} of b, città" for i in range(2000)).encode(), "c.SOG": b"", "d.SOG": b"\n\nx"}
    (tmp_path / "in").mkdir()
    for name, content in texts.items():
        (tmp_path / "in" / name).write_bytes(content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        lines = files.read_lines(spark, str(tmp_path / "in"))
        assert lines.rdd.getNumPartitions() > 10
        lines.write.parquet(str(tmp_path / "lines"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = files.numbered(spark.read.parquet(str(tmp_path / "lines"))).collect()
    assert {(r.filename, r.line_no, r.value) for r in got} == {
        *(("a.SOG", i, f"line {i} of a, città") for i in range(3000)),
        *(("b.SOG", i, f"line {i} of b, città") for i in range(2000)),
        ("d.SOG", 0, ""),
        ("d.SOG", 1, ""),
        ("d.SOG", 2, "x"),
    }
    assert len(got) == 5003


def test_delivery_replaces_its_municipalities(spark, tmp_path):
    schema, path = "codice string, n int", str(tmp_path / "t")
    first = spark.createDataFrame([("H501", 1), ("A001", 2), ("A001", 3), ("B 2", 4), (None, 5)], schema)
    sinks.store_delivery({"x": first}, path, first.select("codice"))
    second = spark.createDataFrame([("H501", 10), ("Z999", 11)], schema)
    for _ in range(2):
        sinks.store_delivery({"x": second}, path, spark.createDataFrame([("H501",), ("B 2",), (None,)], "codice string"))
    assert sorted((r.codice, r.n) for r in spark.read.parquet(f"{path}/x").collect()) == [("A001", 2), ("A001", 3), ("H501", 10)]
    sinks.store_delivery({"x": second.limit(0)}, path, spark.createDataFrame([("A001",)], "codice string"))
    assert [(r.codice, r.n) for r in spark.read.parquet(f"{path}/x").collect()] == [("H501", 10)]
    assert folders.names(spark, str(tmp_path / "absent")) == []


def test_database_is_brought_up_to_a_delivery(spark, tmp_path):
    url, settings = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    schema = "codice string, n int"
    read = lambda: sorted((r.codice, r.n) for r in spark.read.jdbc(url, "titoli", properties=settings).collect())
    sinks.store_jdbc(spark.createDataFrame([("H501", 1), ("A001", 2), (None, 3)], schema), url, "titoli", settings)
    assert read() == [("A001", 2), ("H501", 1)]
    second = spark.createDataFrame([("H501", i) for i in range(50)], schema)
    for _ in range(2):
        sinks.store_jdbc(second, url, "titoli", settings, connections=3)
    assert read() == [("A001", 2), *(("H501", i) for i in range(50))]
    sinks.store_jdbc(second.limit(0), url, "titoli", settings)
    assert len(read()) == 51
    with pytest.raises(ValueError, match="no name"):
        sinks.store_jdbc(second, url, "titoli; drop table titoli", settings)


def test_buckets_join_without_a_shuffle(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = links.owners_of(*registry._bucketed(spark, sf_dir, 5))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() > 0


def test_large_files_in_parts(spark, sf_dir, tmp_path):
    """Lines of files in parts are numbered across parts, and no part holds a whole file."""
    rows = spark.range(0, 1000).selectExpr("concat('d', id % 2, '.FAB') as filename", "id", "lpad(cast(id div 100 as string), 4, '0') as part", "concat('line ', id) as value")
    testbed.place_parts(rows, ["id"], str(tmp_path / "in"))
    assert len(list((tmp_path / "in" / "filename=d0.FAB").glob("part=*/part-*.txt"))) == 10
    files.read_parts(spark, str(tmp_path / "in")).write.parquet(str(tmp_path / "read"))
    got = files.numbered(spark.read.parquet(str(tmp_path / "read"))).collect()
    assert sorted((r.filename, r.line_no, r.value) for r in got) == sorted((f"d{i % 2}.FAB", i // 2, f"line {i}") for i in range(1000))


def test_keys_are_dealt_out(spark, sf_dir, monkeypatch):
    """Lines are rendered by as many tasks as their number asks for, and not by those that read the keys."""
    monkeypatch.setattr(testbed, "KEYS_PER_TASK", 100)
    assert testbed.render_lines(spark, sf_dir, "TER", "1").rdd.getNumPartitions() > 10
