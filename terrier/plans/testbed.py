"""Tables rendered as the texts that the jobs read: map sheets, register lines and archives, by fixed rules over the driver's tables.

Expressions in this module are SQL that Spark and DuckDB both understand, so that the queries' SQL can state what is expected
from the same rules.
"""

from __future__ import annotations

import contextlib
import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.operators.census import Field, fields, layout
from terrier.sources import folders

ORDERS_PER_SHEET = 500
#: Sheets have names of their own within a delivery; in the next one names come again.
SHEETS_PER_DELIVERY = 10_000
DOCUMENTS_PER_ARCHIVE = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The name of sheet number s.
SHEET_NAME = "concat('H', lpad(concat(s % 1000), 3, '0'), substr('ABCD', cast(s % 4 as int) + 1, 1), lpad(concat(s % 10000), 4, '0'), '00')"
KIND = "case k % 5 when 0 then 'BORDO' when 1 then 'TESTO' when 2 then 'SIMBOLO' when 3 then 'FIDUCIALE' else 'LINEA' end"
CODE = "case c % 5 when 0 then name when 1 then 'STRADA' when 2 then 'ACQUA' when 3 then concat(k, '+') else concat(k) end"
TEXT = "case when k % 11 = 0 then 'LINEA' else concat('T', k) end"
SIZE, ANGLE = "concat(k % 50)", "concat(k % 360, '.000')"
X, Y, INNER_Y = "concat(cast(p as decimal(12,3)))", "concat(c, '.000')", "concat(c % 100, '.500')"
MAPPA = "case when s % 7 = 2 then 'MAPA' when s % 7 = 5 then 'QUADRO' else case s % 3 when 0 then 'MAPPA' when 1 then 'MAPPA FONDIARIO' else 'QUADRO D''UNIONE' end end"
SCALE = "case s % 2 when 0 then '4000.000' else '2000.000' end"
#: Fields of each kind of object, n being the number of the order's lines and nisle the number of islands.
OBJECT_FIELDS = {
    "BORDO": [CODE, SIZE, ANGLE, X, Y, X, INNER_Y, "concat(nisle)", "concat(n)"],
    "TESTO": [TEXT, SIZE, ANGLE, X, Y],
    "SIMBOLO": ["concat(k % 20)", ANGLE, X, Y],
    "FIDUCIALE": ["concat(k)", "concat(k % 7)", X, Y, X, INNER_Y],
    "LINEA": ["concat(k % 9)", "concat(n)"],
}
#: How many islands, and the size of the first; each further one is larger by one.
ISLES = "case when n >= 2 and k % 3 = 0 then cast(k % 9 / 3 as int) + 1 else 0 end"
ISLE = "case when n >= 2 and k % 3 = 0 then cast(floor(n / 2) as int) else 0 end"
#: Faults by s % 8, for the sheets of render_sheets(faults=True): lines that stand before EOF, whether EOF stands, and what is behind it.
FAULTS = [
    ([], True, None),
    (["POLIGONO"], True, None),
    (["TESTO", "abc"], False, None),
    ([], True, "more text"),
    ([], False, None),
    (["LINEA", "1", "x"], True, None),
    (["BORDO", "", "1", "0", "0", "0", "0", "0", "0", "0"], True, None),
    (["", "TESTO"], True, None),
]


#: What is rendered already, by application and key: where it lies.
_RENDERED: dict[tuple, str] = {}


@contextlib.contextmanager
def _short_methods(spark: SparkSession) -> Iterator[None]:
    """While texts of many fields are rendered, Spark cuts expressions into methods that HotSpot compiles (8000 bytes), as its documentation advises."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _rendered(spark: SparkSession, key: tuple, make: Callable[[], DataFrame]) -> DataFrame:
    """The same rows from the shared folder, rendered once an application: jobs read their inputs as files, as they would elsewhere."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _RENDERED:
        path = scratch(spark, "rendered")
        with _short_methods(spark):
            make().write.parquet(path)
        _RENDERED[key] = path
    return spark.read.parquet(_RENDERED[key])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared one; on one machine without such a setting, in a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="terrier-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def render_sheets(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """Sheets as files: see _sheets()."""
    return _rendered(spark, ("sheets", sf_dir, faults), lambda: _sheets(spark, sf_dir, faults))


def _sheets(spark: SparkSession, sf_dir: str, faults: bool) -> DataFrame:
    """(delivery, filename, filetype, content): an object for each order, ORDERS_PER_SHEET to a sheet, with the order's lines as vertices."""
    # texts are joined as soon as they can be: arrays of lines cost far more to build, to sort and to shuffle
    x, y = (f"lpad(cast(cast({c} as decimal(12,3)) as string), 14, ' ')" for c in ("l_extendedprice", "l_quantity"))
    pair = F.expr(f"nullif(concat_ws('\r\n', {x}, {y}), '')").alias("pair")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", pair).alias("l"))
    # dealt out first: an order's lines seldom share a task, so that collecting them before would only sort and spill
    lines = lines.repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_list("l")).alias("l"))
    lines = lines.select("k", F.size("l").alias("n"), F.array_join("l.pair", "\r\n").alias("vertices"))
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "o_custkey as c", "o_totalprice as p", f"o_orderkey div {ORDERS_PER_SHEET} as s")
    rows = orders.join(lines, "k", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("vertices", F.expr("nullif(vertices, '')"))
    rows = rows.withColumn("name", F.expr(SHEET_NAME)).withColumn("isle", F.expr(ISLE)).withColumn("nisle", F.expr(ISLES)).withColumn("kind", F.expr(KIND))

    def text(kind: str) -> str:
        parts = [f"concat('{kind}', case when k % 7 = 0 then '\\\\' else '' end)", *OBJECT_FIELDS[kind]]
        if kind == "BORDO":
            parts += [f"case when {i} < nisle then concat('  ', isle + {i}) end" for i in range(3)]
        return f"concat_ws('\r\n', {', '.join(parts + ['vertices'] * (kind in ('BORDO', 'LINEA')))})"

    rows = rows.withColumn("text", F.expr("case kind " + " ".join(f"when '{k}' then {text(k)}" for k in OBJECT_FIELDS) + " end"))
    sheets = rows.groupBy("s", "name").agg(F.array_sort(F.collect_list(F.struct("k", "text"))).alias("o"))
    tail = F.lit("EOF")
    if faults:
        tail = F.lit(None).cast("string")
        for i, (before, eof, behind) in reversed(list(enumerate(FAULTS))):
            found = [*before, *(["EOF"] if eof else []), *([behind] if behind else [])]
            tail = F.when(F.col("s") % len(FAULTS) == i, F.lit("\r\n".join(found) if found else None)).otherwise(tail)
    content = F.concat(F.concat_ws("\r\n", F.expr(MAPPA), "name", F.concat(F.lit("   "), F.expr(SCALE)), F.array_join("o.text", "\r\n"), tail), F.lit("\r\n"))
    return sheets.select(F.expr(f"cast(s div {SHEETS_PER_DELIVERY} as int)").alias("delivery"), F.concat("name", F.lit(".CTF")).alias("filename"), F.lit(".CTF").alias("filetype"), content.alias("content"))


#: Row source of each register's lines: table, key k and municipality key g.
LINE_SOURCES = {
    ("FAB", "1"): ("part", "p_partkey", "p_partkey"),
    ("FAB", "2"): ("supplier", "s_suppkey", "s_suppkey"),
    ("FAB", "3"): ("supplier", "s_suppkey", "s_suppkey"),
    ("FAB", "4"): ("part", "p_partkey", "p_partkey"),
    ("FAB", "5"): ("orders", "o_orderkey", "o_orderkey"),
    ("TER", "1"): ("orders", "o_orderkey", "o_orderkey"),
    ("TER", "2"): ("orders", "o_orderkey", "o_orderkey"),
    ("TER", "3"): ("orders", "o_orderkey", "o_orderkey"),
    ("TER", "4"): ("orders", "o_orderkey", "o_orderkey"),
    ("SOG", None): ("customer", "c_custkey", "c_custkey"),
    ("TIT", None): ("orders", "o_orderkey", "o_custkey"),
}


def raw_field(register: str, record_type: str | None, name: str) -> str:
    """The text of a field, as an expression of k and g."""
    i = layout(register, record_type).index(name)
    fixed = {
        "codice_ammvo": "concat('H', lpad(concat(g % 50), 3, '0'))",
        "sezione": "case when g % 9 = 0 then '' else substr('ABCD', cast(g % 4 as int) + 1, 1) end",
        "identificativo_immobile": "case when k % 31 = 0 then 'x12' else concat(g % 1800) end" if register == "TIT" else "case when k % 37 = 0 then '' else concat(k) end",
        "tipo_immobile": {"FAB": "'F'", "TER": "'T'"}.get(register, "case when g % 5 = 0 then 'T' else 'F' end"),
        "progressivo": "concat(k % 3 + 1)",
        "tipo_record": f"'{record_type}'",
        "identificativo_soggetto": f"case when k % {29 if register == 'TIT' else 23} = 0 then 'n.d.' else concat(g) end",
        "tipo_soggetto": "case when g % 3 <> 0 then 'P' else 'G' end",
        "foglio": f"case when k % {41 if register == 'TER' else 43} = 0 then 'x12' else lpad(concat(k % 200), 4, '0') end",
        "numero": "concat(k % 500)",
        "denominatore": "case when k % 4 = 0 then '' else concat(k % 3) end",
        "quota_numeratore": "concat(k % 10 + 1)",
        "quota_denominatore": "case when k % 11 = 0 then '' else concat(k % 12 + 1) end",
    }
    if name in fixed:
        return fixed[name]
    kinds = {f.kind for t in _tables(register, record_type) for f in fields(t) if f.source == name}
    if kinds & {"int", "itext"}:
        return f"case (k + {i}) % 8 when 0 then concat(' ', k, ' ') when 1 then concat('000', k) when 2 then concat('+', k) when 3 then '2.7' when 4 then '' when 5 then '1_000' when 6 then concat('-', k) else concat(k) end"
    if kinds & {"num", "trunc"}:
        return f"case (k + {i}) % 6 when 0 then '' when 1 then concat(k % 1000 + 1, '00000.0') when 2 then 'n.d.' when 3 then concat(' ', k % 97, '.25') else concat(k % 1000, '.', (k + {i}) % 10) end"
    return f"case when (k + {i}) % 13 = 0 then '' else concat('v', (k * 7 + {i}) % 101) end"


def _tables(register: str, record_type: str | None) -> list[str]:
    from terrier.operators.census import ORIGINS

    return [t for t, origin in ORIGINS.items() if origin == (register, record_type)]


def _keys(spark: SparkSession, sf_dir: str, name: str, k: str, g: str) -> DataFrame:
    """(k, g) of a table's rows, dealt out by k: keys are small, so that a few tasks would read all of them, and then render all lines."""
    rows = table(spark, sf_dir, name).select(F.col(k).alias("k"), F.col(g).alias("g"))
    return rows.repartition(rows.count() // KEYS_PER_TASK + 1, "k")


def render_lines(spark: SparkSession, sf_dir: str, register: str, record_type: str | None) -> DataFrame:
    """(register, value): a delimited line for each row of the record type's source."""
    name, k, g = LINE_SOURCES[register, record_type]
    raw = [F.expr(raw_field(register, record_type, f)) for f in layout(register, record_type)]
    rows = _keys(spark, sf_dir, name, k, g)
    return rows.select(F.lit(register).alias("register"), F.array_join(F.array(*raw), "|").alias("value"))


def register_lines(spark: SparkSession, sf_dir: str, register: str) -> DataFrame:
    """All lines of a register, its record types mixed, from files."""
    return _rendered(spark, ("lines", sf_dir, register), lambda: _lines(spark, sf_dir, register))


def _lines(spark: SparkSession, sf_dir: str, register: str) -> DataFrame:
    parts = [render_lines(spark, sf_dir, r, t) for r, t in LINE_SOURCES if r == register]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: What is wrong with a line, by its key: its type is unknown (1) or blank (2), it lacks its last field (3) or has one too many (4); 5 is in quotes, which is right.
FAULT = "case when k % 17 <> 0 then 0 else 1 + cast(floor(k / 17) as int) % 5 end"
FILES_PER_REGISTER = 3
KEYS_PER_TASK = 100_000
#: Register files lie in parts of so many keys, so that no task writes a whole file; and so many lines are rendered by a task, about.
KEYS_PER_PART, LINES_PER_TASK = 150_000, 250_000
#: Sheets are rows of many lines, each a file of its own.
SHEETS_PER_TASK = 50


def register_fault(register: str) -> str:
    """FAULT, without the faults of types where a register has none."""
    return FAULT if register in ("FAB", "TER") else f"case when ({FAULT}) in (1, 2) then 0 else ({FAULT}) end"


def place_files(rows: DataFrame, order: list[str], folder: str, encoding: str = "UTF-8") -> None:
    """Write rows(filename, value, ...) as text files of those names, lines in that order, and in folders of their own if rows have a folder. Files are written by Spark; only their names are then moved."""
    spark, held = rows.sparkSession, f"{folder}-parts-{uuid.uuid4().hex}"
    keys = ["folder", "filename"] if "folder" in rows.columns else ["filename"]
    lines = rows.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, "value")
    plain = {"encoding": encoding, "sep": "\x01", "quote": "", "escapeQuotes": "false", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    (lines.write.partitionBy(*keys).text(held) if encoding == "UTF-8" else lines.write.partitionBy(*keys).options(**plain).csv(held))
    folders.make(spark, folder)
    made, moves = set(), []
    for part in folders.below(spark, held):
        *inner, _ = (n.partition("=")[2] for n in part.split("/"))
        if inner:
            if len(inner) == 2 and inner[0] not in made:
                folders.make(spark, f"{folder}/{inner[0]}")
                made.add(inner[0])
            moves.append((f"{held}/{part}", "/".join((folder, *inner))))
    folders.move_all(spark, moves)
    folders.remove(spark, held)


def place_parts(rows: DataFrame, order: list[str], folder: str, *inner: str, per_task: int = LINES_PER_TASK) -> None:
    """Write rows(filename, value, ...) as text files in parts, as read_parts() takes them: for each file a folder, within folders by inner. Rows with a part (a text, else 0) are dealt out by it and lie in that order of parts; nothing is renamed. per_task: about so many rows are written by a task."""
    rows = rows if "part" in rows.columns else rows.withColumn("part", F.lit("0"))
    keys = [*inner, "filename", "part"]
    tasks = rows.count() // per_task + 1
    with _short_methods(rows.sparkSession):
        rows.repartition(tasks, *keys).sortWithinPartitions(*keys, *order).select(*keys, "value").write.partitionBy(*keys).text(folder)


def register_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with FILES_PER_REGISTER files of each register, in parts, some of whose lines have faults: d0.FAB, d1.FAB, ... Rendered once an application."""
    key = (spark.sparkContext.applicationId, "register files", sf_dir)
    if key not in _RENDERED:
        _RENDERED[key] = scratch(spark, "registers")
        parts = [faulty_lines(spark, sf_dir, r, t) for r, t in LINE_SOURCES]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        part = F.lpad(F.expr(f"k div {KEYS_PER_PART}").cast("string"), 12, "0")
        place_parts(rows.withColumn("part", part), ["k", "record_type"], _RENDERED[key])
    return _RENDERED[key]


def faulty_lines(spark: SparkSession, sf_dir: str, register: str, record_type: str | None) -> DataFrame:
    """(filename, k, record_type, value): the lines of render_lines() with their faults."""
    name, k, g = LINE_SOURCES[register, record_type]
    fault = register_fault(register)
    raw = [f"({raw_field(register, record_type, f)})" for f in layout(register, record_type)]
    if record_type:
        raw[5] = f"case ({fault}) when 1 then '9' when 2 then ' ' else '{record_type}' end"
    rows = _keys(spark, sf_dir, name, k, g)
    # no field holds a bar or a quote
    rows = rows.select("k", F.array_join(F.array(*map(F.expr, raw)), "|").alias("v"), F.expr(fault).alias("fault"))
    quoted = F.concat(F.lit('"'), F.replace("v", F.lit("|"), F.lit('"|"')), F.lit('"'))
    found = F.when(F.col("fault") == 3, F.substring_index("v", "|", len(raw) - 1)).when(F.col("fault") == 4, F.concat("v", F.lit("|more"))).when(F.col("fault") == 5, quoted).otherwise(F.col("v"))
    return rows.select(F.expr(f"concat('d', k % {FILES_PER_REGISTER}, '.{register}')").alias("filename"), "k", F.lit(record_type or "").alias("record_type"), found.alias("value"))


def expected_lines() -> str:
    """DuckDB SQL of the lines of register_files(): register, filename, line_no, k, g, record_type, fault."""
    parts = " union all ".join(
        f"select '{r}' as register, concat('d', k % {FILES_PER_REGISTER}, '.{r}') as filename, k, g, '{t or ''}' as record_type, {register_fault(r)} as fault from (select {k} as k, {g} as g from {source})"
        for (r, t), (source, k, g) in LINE_SOURCES.items()
    )
    return f"select *, row_number() over (partition by filename order by k, record_type) - 1 as line_no from ({parts})"


def expected_field(register: str, record_type: str | None, f: Field) -> str:
    """DuckDB SQL of a target column."""
    if f.source is None:
        return "cast(null as integer)" if f.kind == "nullint" else "cast(null as varchar)"
    raw = raw_field(register, record_type, f.source)
    whole = f"case when regexp_full_match(trim({raw}), '[+-]?\\d+') then try_cast(trim({raw}) as integer) end"
    return {
        "int": whole,
        "itext": f"cast({whole} as varchar)",
        "num": f"regexp_replace(cast(try_cast(trim({raw}) as decimal(18,3)) as varchar), '0{{1,2}}$', '')",
        "trunc": f"cast(trunc(try_cast(trim({raw}) as double)) as integer)",
    }.get(f.kind, raw)


def expected_table(name: str, more: str = "") -> str:
    """DuckDB SQL of a target table. more: a condition on the keys k and g of its lines."""
    from terrier.operators.census import ORIGINS

    origin = ORIGINS[name]
    source, k, g = LINE_SOURCES[origin]
    columns = ", ".join(f"{expected_field(*origin, f)} as {f.target}" for f in fields(name))
    where = {"ctfisica": "g % 3 <> 0", "ctnonfis": "g % 3 = 0"}.get(name, "true")
    return f"select {columns} from (select {k} as k, {g} as g from {source}) where {where}{f' and ({more})' if more else ''}"


def render_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives as files: see _archives()."""
    return _rendered(spark, ("archives", sf_dir), lambda: _archives(spark, sf_dir))


def _archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(archive, content): zips of at most DOCUMENTS_PER_ARCHIVE documents each; every document is a member of its own and overwrites last.txt.

    Before the nested archive stands one that is broken.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.expr(f"concat('z', doc_id div {DOCUMENTS_PER_ARCHIVE}, '.zip')").alias("archive"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            z.mkdir("texts")
            for i, text in zip(group["doc_id"], group["text"], strict=True):
                z.writestr(f"texts/d{i}.txt", text or "")
            inner = io.BytesIO()
            with zipfile.ZipFile(inner, "w") as y:
                y.writestr("last.txt", (group["text"].iloc[-1] or ""))
            z.writestr("broken.zip", b"no archive")
            z.writestr("inner.zip", inner.getvalue())
        return pd.DataFrame({"archive": [group["archive"].iloc[0]], "content": [held.getvalue()]})

    return docs.groupBy("archive").applyInPandas(pack, "archive string, content binary")
