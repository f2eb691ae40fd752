"""Map sheets: name, header, records, typed objects, vertices and islands. One row per file until the objects are exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.scalars import safe_int, strip

# The fields of each kind of record, one to a line, in order.
FIELDS = {
    "BORDO": ("codice_identificativo", "dimensione", "angolo", "posizione_x", "posizione_y", "punto_interno_x", "punto_interno_y", "numero_isole", "numero_vertici"),
    "TESTO": ("testo", "dimensione", "angolo", "posizione_x", "posizione_y"),
    "SIMBOLO": ("codice_simbolo", "angolo", "posizione_x", "posizione_y"),
    "FIDUCIALE": ("numero_identificativo", "codice_simbolo", "posizione_x", "posizione_y", "punto_rappresentazione_x", "punto_rappresentazione_y"),
    "LINEA": ("codice_tipo_tratto", "numero_vertici"),
}
# Names under which a sheet's codes and header are exported.
ALIASES = {
    "codice_foglio": "CODICE_FOGLIO",
    "codice_comune": "CODICE_COMUNE",
    "codice_sezione_censuaria": "CODICE SEZIONE CENSUARIA",
    "codice_numero_foglio": "CODICE NUMERO FOGLIO",
    "numero_foglio": "NUMERO FOGLIO",
    "codice_allegato": "CODICE ALLEGATO",
    "codice_sviluppo": "CODICE SVILUPPO",
}
HEADER_ALIASES = {"mappa": "MAPPA", "nome_mappa": "NOME MAPPA", "scala_originaria": "SCALA ORIGINARIA"}


def base_name(files: DataFrame) -> DataFrame:
    """With name: the file name in capitals without its suffix, wherever that stands."""
    return files.withColumn("name", F.when(F.col("filetype") == "", F.upper("filename")).otherwise(F.replace(F.upper("filename"), F.upper("filetype"), F.lit(""))))


def decode_name(name: Column | str) -> dict[str, Column]:
    """The parts of a sheet's name, by place. Null parts and a false ok for names of fewer than 11 characters."""
    name = F.col(name) if isinstance(name, str) else name
    ok = F.coalesce(F.length(name) >= 11, F.lit(False))

    def part(start: int, n: int) -> Column:
        return F.when(ok, F.substring(name, start, n))

    return {
        "codice_foglio": F.when(ok, name),
        "codice_comune": part(1, 4),
        "codice_sezione_censuaria": part(5, 1),
        "codice_numero_foglio": part(6, 4),
        "numero_foglio": F.when(ok, F.ltrim(F.substring(name, 6, 4), F.lit("0"))),
        "codice_allegato": part(10, 1),
        "codice_sviluppo": part(11, 1),
        "name_ok": ok,
    }


def split_lines(content: Column | str, most: int = -1) -> Column:
    """The lines of a text, ended by CR LF, CR or LF; the end of the last line makes no line of its own. most: how many are told apart, the last with all that follows."""
    lines = F.split(content, "\r\n|\r|\n", most)
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)


def text_lines(text: Column | str) -> Column:
    """The lines of a text of any kind, ended by LF alone: a CR belongs to its line. The end of the last line makes no line of its own; an empty text is one empty line."""
    lines = F.split(text, "\n")
    return F.when(F.col(text).endswith("\n") if isinstance(text, str) else text.endswith("\n"), F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)


def header(lines: Column | str) -> dict[str, Column]:
    lines = F.col(lines) if isinstance(lines, str) else lines
    first = [F.get(lines, F.lit(i)) for i in range(3)]
    return {"mappa": strip(first[0]), "nome_mappa": strip(first[1]), "scala_originaria": strip(first[2]), "scala": strip(first[2]).try_cast("double"), "header_ok": first[2].isNotNull()}


def headers(files: DataFrame) -> DataFrame:
    """The parts of name and header that parse_sheets() gives, from the first lines alone: no record is looked at."""
    first = F.coalesce(F.transform(split_lines("content", 4), strip), F.array().cast("array<string>"))
    named = base_name(files).withColumns(decode_name("name")).withColumn("lines", first).withColumns(header("lines"))
    return named.drop("name", "lines", "content")


def _count(offset: int) -> str:
    """The count in a line behind a marker. More than the sheet has lines (or than a long holds) is as good as one more: the record is truncated."""
    return f"least(size(lines) + 1L, greatest(0L, coalesce(try_cast(get(lines, c.p + {offset}) as bigint), size(lines) + 1L)))"


def _digits(offset: int) -> str:
    return f"get(lines, c.p + {offset}) rlike '^[+-]?[0-9]+$'"


#: Lines of a record; null for a count that is none.
_LENGTH = f"""case c.m when 'BORDO' then case when {_digits(8)} and {_digits(9)} then 10 + {_count(8)} + 2 * {_count(9)} end
 when 'LINEA' then case when {_digits(2)} then 3 + 2 * {_count(2)} end
 when 'TESTO' then 6L when 'SIMBOLO' then 5L when 'FIDUCIALE' then 7L when 'EOF' then 1L end"""

#: The walk over marker lines in order. A marker inside a record is rejected, one right at the record's end begins the next,
#: one behind it means that the line at the end is no marker. Rejected places are few, so collecting those keeps it linear.
_WALK = """aggregate(marks,
 named_struct('next', 3, 'eof', -1, 'broken', -1, 'bad', -1, 'rejected', cast(array() as array<int>)),
 (s, c) -> case
  when s.eof >= 0 or s.broken >= 0 or s.bad >= 0 then s
  when c.p < s.next then named_struct('next', s.next, 'eof', s.eof, 'broken', s.broken, 'bad', s.bad, 'rejected', array_append(s.rejected, c.p))
  when c.p > s.next then named_struct('next', s.next, 'eof', s.eof, 'broken', s.next, 'bad', s.bad, 'rejected', s.rejected)
  when c.len is null then named_struct('next', s.next, 'eof', s.eof, 'broken', s.broken, 'bad', c.p, 'rejected', s.rejected)
  when c.m = 'EOF' then named_struct('next', c.p + 1, 'eof', c.p, 'broken', s.broken, 'bad', s.bad, 'rejected', s.rejected)
  else named_struct('next', s.next + c.len, 'eof', s.eof, 'broken', s.broken, 'bad', s.bad, 'rejected', s.rejected) end)"""


def parse_sheets(files: DataFrame) -> DataFrame:
    """One row for each file(filename, filetype, content): name and header parts, status, and objects as an array.

    status: ok, bad_name, short_header, unknown_object, truncated, bad_count or bad_code; bad_line is the place (from 0) of what
    is wrong and bad_text its line. Only sheets with status ok have objects. garbage is the first line after EOF, if any; a
    missing EOF is no fault. objects: record_no, kind, had_backslash, fields.
    """
    named = base_name(files)
    named = named.withColumns(decode_name("name")).withColumn("lines", F.coalesce(F.transform(split_lines("content"), strip), F.array().cast("array<string>")))
    named = named.drop("content")
    named = named.withColumns(header("lines"))
    marks = F.expr(f"""transform(filter(transform(lines, (x, i) -> named_struct('p', i, 'm', rtrim('\\\\', x))),
        c -> c.p >= 3 and c.m in ('BORDO', 'TESTO', 'SIMBOLO', 'FIDUCIALE', 'LINEA', 'EOF')),
        c -> named_struct('p', c.p, 'm', c.m, 'len', cast({_LENGTH} as int)))""")
    walked = named.withColumn("marks", marks).withColumn("walk", F.expr(_WALK))
    # places are numbers, so that the rejected ones are taken out by hash and not by search
    places = "array_except(transform(filter(marks, c -> c.m <> 'EOF' and c.p < walk.next and (walk.eof < 0 or c.p < walk.eof)), c -> c.p), walk.rejected)"
    kept = F.expr(f"transform(transform({places}, p -> named_struct('p', p, 'm', rtrim('\\\\', get(lines, p)))), c -> named_struct('p', c.p, 'm', c.m, 'len', cast({_LENGTH} as int)))")
    size = F.size("lines")
    unknown = F.when(F.col("walk.broken") >= 0, F.col("walk.broken")).when((F.col("walk.eof") < 0) & (F.col("walk.bad") < 0) & (F.col("walk.next") < size), F.col("walk.next"))
    walked = walked.withColumn("marks", kept).withColumn("unknown", unknown)
    no_code = F.expr("get(filter(marks, c -> c.m = 'BORDO' and get(lines, c.p + 1) = ''), 0).p")
    walked = walked.withColumn("no_code", no_code)
    status = (
        F.when(~F.col("name_ok"), "bad_name")
        .when(~F.col("header_ok"), "short_header")
        .when((F.col("walk.eof") < 0) & (F.col("walk.next") > size), "truncated")
        .when(F.col("walk.bad") >= 0, F.when(F.expr("exists(array(walk.bad), b -> b + (case get(lines, b) when 'LINEA' then 3 else 10 end) > size(lines))"), "truncated").otherwise("bad_count"))
        .when(F.col("unknown").isNotNull(), "unknown_object")
        .when(F.col("no_code").isNotNull(), "bad_code")
        .otherwise("ok")
    )
    place = F.when(F.col("status").isin("truncated"), size).when(F.col("status") == "bad_count", F.col("walk.bad")).when(F.col("status") == "unknown_object", F.col("unknown")).when(F.col("status") == "bad_code", F.col("no_code"))
    walked = walked.withColumn("status", status).withColumn("bad_line", place)
    walked = walked.withColumn("bad_text", F.get("lines", F.col("bad_line"))).withColumn("garbage", F.when(F.col("walk.eof") >= 0, F.get("lines", F.col("walk.eof") + 1)))
    objects = F.when(
        F.col("status") == "ok",
        F.expr("transform(marks, (c, i) -> named_struct('record_no', i, 'kind', c.m, 'had_backslash', get(lines, c.p) <> c.m, 'fields', slice(lines, c.p + 2, c.len - 1)))"),
    )
    keep = [c for c in files.columns if c not in ("content", "lines")]
    # a generator of one row: filters on what it gives stay above it, where each expression of the walk is evaluated once
    found = F.struct(*[F.col(c) for c in (*decode_name("name"), *header("lines"), "status", "bad_line", "bad_text", "garbage")], objects.alias("objects"))
    return walked.select(*keep, F.inline_outer(F.array(found)))


def objects(sheets: DataFrame, *more: str) -> DataFrame:
    """(codice_foglio, record_no, kind, had_backslash, fields), behind more columns of the sheets: one row for each object of those that are ok."""
    return sheets.select(*more, "codice_foglio", F.explode("objects").alias("o")).select(*more, "codice_foglio", "o.record_no", "o.kind", "o.had_backslash", "o.fields")


def of_kind(objects_: DataFrame, kind: str) -> DataFrame:
    """The named fields of one kind of object, as text; BORDO and LINEA keep vertices, BORDO islands and type too."""
    names = FIELDS[kind]
    columns = [F.get("fields", F.lit(i)).alias(n) for i, n in enumerate(names)]
    rows = objects_.where(F.col("kind") == kind)
    keys = ["codice_foglio", "record_no", "had_backslash"]
    if kind == "BORDO":
        n = F.greatest(F.lit(0), safe_int(F.get("fields", F.lit(7))))
        return rows.select(*keys, *columns, F.slice("fields", F.lit(10), n).alias("isole"), vertices(F.lit(9) + n, safe_int(F.get("fields", F.lit(8)))).alias("vertici"), border_type(F.get("fields", F.lit(0))).alias("tipo"))
    if kind == "LINEA":
        return rows.select(*keys, *columns, vertices(F.lit(2), safe_int(F.get("fields", F.lit(1)))).alias("vertici"))
    return rows.select(*keys, *columns)


def vertex_lists(objects_: DataFrame) -> DataFrame:
    """(codice_foglio, record_no, kind, vertici): the vertices of borders and lines alike, as of_kind() gives them for each, in one pass over the objects."""
    border = F.col("kind") == "BORDO"
    start = F.when(border, F.greatest(F.lit(0), safe_int(F.get("fields", F.lit(7)))) + 9).otherwise(F.lit(2))
    n = safe_int(F.get("fields", F.when(border, F.lit(8)).otherwise(F.lit(1))))
    return objects_.where(F.col("kind").isin("BORDO", "LINEA")).select("codice_foglio", "record_no", "kind", vertices(start, n).alias("vertici"))


def vertices(start: Column, n: Column, fields: Column | str = "fields") -> Column:
    """Pairs (x, y) from a list of fields, n of them from a place on; none if n isn't positive."""
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(F.get(fields, start + 2 * i).alias("x"), F.get(fields, start + 2 * i + 1).alias("y")))
    return F.when(n > 0, pairs).otherwise(F.array().cast("array<struct<x:string,y:string>>"))


def border_type(code: Column | str) -> Column:
    """What a border's code says, the first rule that fits; null for an empty code."""
    code = F.col(code) if isinstance(code, str) else code
    return (
        F.when(F.length(code) == 11, "CONFINE").when(code == "STRADA", "STRADA").when(code == "ACQUA", "ACQUA").when(code.endswith("+"), "FABBRICATO").when(F.length(code) > 0, "PARTICELLA")
    )


def vertex_rows(typed: DataFrame) -> DataFrame:
    """(codice_foglio, record_no, vertex_no, x, y) with numbers for the coordinates."""
    rows = typed.select("codice_foglio", "record_no", F.posexplode("vertici").alias("vertex_no", "v"))
    return rows.select("codice_foglio", "record_no", "vertex_no", F.col("v.x").try_cast("decimal(12,3)").alias("x"), F.col("v.y").try_cast("decimal(12,3)").alias("y"))


def island_rows(borders: DataFrame) -> DataFrame:
    rows = borders.select("codice_foglio", "record_no", F.posexplode("isole").alias("island_no", "n"))
    return rows.withColumn("n", safe_int("n"))


def documents(sheets: DataFrame) -> DataFrame:
    """One nested document per sheet, objects by kind in file order. Built in the sheet's own row: nothing is shuffled."""

    def only(kind: str) -> Column:
        return F.filter("objects", lambda o: o["kind"] == kind)

    of = {k.lower(): only(k) for k in FIELDS}
    return sheets.where("status = 'ok'").select("codice_foglio", "codice_comune", F.struct("mappa", "nome_mappa", "scala_originaria").alias("header"), F.struct(*[c.alias(k) for k, c in of.items()]).alias("oggetti"))


def regrouped(objects_: DataFrame, *order: str) -> DataFrame:
    """The same lists from the flat table of objects. order: columns that tell the files of one sheet apart, and order them."""
    each = [F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct(*order, "record_no", "kind", "had_backslash", "fields")))).alias(k.lower()) for k in FIELDS]
    return objects_.groupBy("codice_foglio").agg(*each)


def exported(sheets: DataFrame) -> DataFrame:
    """(codice_foglio, sheet): codes, header and objects by kind of each sheet that is ok, under their exported names.

    An object has its named fields; borders and lines have their vertices, borders their islands too. to_json(sheet) is the document.
    """

    def named(o: Column, kind: str) -> Column:
        fields = o["fields"]
        out = [F.get(fields, F.lit(i)).alias(n) for i, n in enumerate(FIELDS[kind])]
        if kind == "BORDO":
            n = F.greatest(F.lit(0), safe_int(F.get(fields, F.lit(7))))
            out += [F.slice(fields, F.lit(10), n).alias("isole"), vertices(F.lit(9) + n, safe_int(F.get(fields, F.lit(8))), fields).alias("vertici")]
        if kind == "LINEA":
            out.append(vertices(F.lit(2), safe_int(F.get(fields, F.lit(1))), fields).alias("vertici"))
        return F.struct(*out)

    def all_of(kind: str) -> Column:
        return F.transform(F.filter("objects", lambda o: o["kind"] == kind), lambda o: named(o, kind)).alias(kind)

    of = [all_of(k) for k in FIELDS]
    codes = [F.col(c).alias(a) for c, a in ALIASES.items()]
    header = F.struct(*[F.col(c).alias(a) for c, a in HEADER_ALIASES.items()]).alias("header")
    return sheets.where("status = 'ok'").select("codice_foglio", F.struct(*codes, header, F.struct(*of, F.array().cast("array<string>").alias("EOF")).alias("oggetti")).alias("sheet"))
