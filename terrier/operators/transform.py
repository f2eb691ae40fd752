"""Coordinate transforms from a table of parameters: of all points and vertices of a sheet, or of vertices only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.operators.sheets import FIELDS

#: Parameter rows are sent to all tasks up to this many; beyond it they are joined by key.
BROADCAST_ROWS = 1_000_000
#: x' = a0 + a1 x + a2 y, y' = b0 + b1 x + b2 y
PARAMETERS = ("a0", "a1", "a2", "b0", "b1", "b2")
#: Where pairs of coordinates begin in each kind of record, those of its vertices not counted.
PAIRS = {kind: tuple(i for i, n in enumerate(names) if n.endswith("_x")) for kind, names in FIELDS.items()}


def _small(parameters: DataFrame) -> bool:
    return parameters.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def with_parameters(sheets: DataFrame, parameters: DataFrame) -> DataFrame:
    """sheets(codice_foglio, codice_comune, ...) with p, the parameters of the sheet itself, or else of its municipality; null where there are neither.

    parameters: code (of a sheet or a municipality), a0, a1, a2, b0, b1, b2. A code that comes twice counts once, with its greatest row.
    Where both have a delivery, parameters with one hold in it only, and come before those of the same code without one, which
    hold in all; a sheet's are still before its municipality's.
    """
    small = _small(parameters)
    dated = "delivery" in parameters.columns and "delivery" in sheets.columns

    def once(rows: DataFrame, name: str, *keys: str) -> DataFrame:
        values = F.max(F.struct(*[F.col(p).cast("double").alias(p) for p in PARAMETERS]))
        found = rows.where("code is not null").groupBy(*[F.col(k).alias(f"_{k}") for k in ("code", *keys)]).agg(values.alias(name))
        return F.broadcast(found) if small else found

    general = parameters.where("delivery is null") if dated else parameters
    out = sheets
    if dated:
        of_delivery = once(parameters.where("delivery is not null"), "_first", "delivery")
        out = out.join(of_delivery, (F.col("codice_foglio") == F.col("_code")) & (F.col("delivery") == F.col("_delivery")), "left").drop("_code", "_delivery")
        named = once(parameters.where("delivery is not null"), "_second", "delivery")
        out = out.join(named, (F.col("codice_comune") == F.col("_code")) & (F.col("delivery") == F.col("_delivery")), "left").drop("_code", "_delivery")
    out = out.join(once(general, "_own"), F.col("codice_foglio") == F.col("_code"), "left").drop("_code")
    out = out.join(once(general, "_p"), F.col("codice_comune") == F.col("_code"), "left").drop("_code")
    of = ["_first", "_own", "_second", "_p"] if dated else ["_own", "_p"]
    return out.withColumn("p", F.coalesce(*of)).drop(*of)


def _moved() -> str:
    """SQL of the objects with all pairs moved; a coordinate that can't be read or doesn't fit becomes null."""
    first = "case o.kind " + " ".join(f"when '{k}' then array({', '.join(map(str, at))})" for k, at in PAIRS.items() if at) + " else cast(array() as array<int>) end"
    vertices = "case o.kind when 'BORDO' then 9 + greatest(0, coalesce(try_cast(o.fields[7] as int), 0)) when 'LINEA' then 2 else 2147483647 end"

    def number(place: str) -> str:
        return f"try_cast(get(o.fields, {place}) as double)"

    def text(a: str, x: str, y: str) -> str:
        return f"cast(try_cast(p.{a}0 + p.{a}1 * {number(x)} + p.{a}2 * {number(y)} as decimal(18,3)) as string)"

    is_x = "array_contains(w.at, i) or (i >= w.from and (i - w.from) % 2 = 0)"
    is_y = "array_contains(w.at, i - 1) or (i > w.from and (i - w.from) % 2 = 1)"
    field = f"case when {is_x} then {text('a', 'i', 'i + 1')} when {is_y} then {text('b', 'i - 1', 'i')} else f end"
    # where the pairs of an object are is told once, and not for each of its fields
    fields = f"transform(array(named_struct('at', {first}, 'from', {vertices})), w -> transform(o.fields, (f, i) -> {field}))[0]"
    return f"transform(objects, o -> named_struct('record_no', o.record_no, 'kind', o.kind, 'had_backslash', o.had_backslash, 'fields', {fields}))"


def convert_sheets(sheets: DataFrame, parameters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sheets as parse_sheets() gives them with every pair of coordinates of every object moved, and (codice_foglio, filename, reason, record_no) of those that aren't.

    Moved coordinates are texts with three decimals, in the places of the old ones, so that all that reads objects reads these
    too. A sheet is converted as a whole or not at all. Reasons: the sheet's own status, no parameters, unreadable coordinate
    (with the first object that has one). Nothing is shuffled while parameters are few.
    """
    placed = with_parameters(sheets, parameters).withColumn("_moved", F.when(F.col("p").isNotNull(), F.expr(_moved())))
    bad = F.expr("get(filter(_moved, o -> exists(o.fields, f -> f is null)), 0).record_no")
    reason = F.when(F.col("status") != "ok", F.col("status")).when(F.col("p").isNull(), "no parameters").when(F.col("_bad").isNotNull(), "unreadable coordinate")
    # a generator of one row: filters on the reason stay above it, so that objects are moved once
    found = F.struct(reason.alias("reason"), F.when(F.col("status") == "ok", F.col("_bad")).alias("bad_record"), F.col("_moved").alias("moved"))
    rows = placed.withColumn("_bad", bad).select(*sheets.columns, F.inline(F.array(found)))
    done = rows.where("reason is null").withColumn("objects", F.col("moved")).select(*sheets.columns)
    return done, rows.where("reason is not null").select("codice_foglio", "filename", "reason", F.col("bad_record").alias("record_no"))


def point_rows(sheets: DataFrame) -> DataFrame:
    """(codice_foglio, record_no, kind, point_no, x, y): every pair of coordinates of every object, those of its vertices last."""
    flat = sheets.select("codice_foglio", F.explode("objects").alias("o")).select("codice_foglio", "o.*")
    start = F.when(F.col("kind") == "BORDO", F.greatest(F.lit(0), F.coalesce(F.get("fields", F.lit(7)).try_cast("int"), F.lit(0))) + 9).when(F.col("kind") == "LINEA", 2)
    fixed = F.lit(None).cast("array<int>")
    for kind, at in PAIRS.items():
        fixed = F.when(F.col("kind") == kind, F.array(*map(F.lit, at)).cast("array<int>")).otherwise(fixed)
    last = F.size("fields") - 2
    of_vertices = F.when(last >= F.col("start"), F.sequence(F.col("start"), last, F.lit(2))).otherwise(F.array().cast("array<int>"))
    placed = flat.withColumn("start", start).withColumn("at", F.concat(fixed, F.coalesce(of_vertices, F.array().cast("array<int>"))))

    def number(place: Column) -> Column:
        return F.get("fields", place).try_cast("double")

    rows = placed.select("codice_foglio", "record_no", "kind", "fields", F.posexplode("at").alias("point_no", "i"))
    return rows.select("codice_foglio", "record_no", "kind", "point_no", number(F.col("i")).alias("x"), number(F.col("i") + 1).alias("y"))


def transform_vertices(typed: DataFrame, parameters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Objects with transformed vertices, and those whose municipality has no parameters. Points stay as they are: see convert_sheets() for whole sheets.

    typed: codice_foglio, ..., vertici; parameters: codice_comune, a0, a1, a2, b0, b1, b2. Arrays are transformed in place.
    """
    keyed = typed.withColumn("codice_comune", F.substring("codice_foglio", 1, 4))
    joined = keyed.join(F.broadcast(parameters) if _small(parameters) else parameters, "codice_comune", "left")
    x, y = (lambda v: v["x"].try_cast("double")), (lambda v: v["y"].try_cast("double"))
    moved = F.transform(
        "vertici",
        lambda v: F.struct((F.col("a0") + F.col("a1") * x(v) + F.col("a2") * y(v)).alias("x"), (F.col("b0") + F.col("b1") * x(v) + F.col("b2") * y(v)).alias("y")),
    )
    done = joined.where("a0 is not null").withColumn("vertici", moved).drop(*PARAMETERS)
    return done, joined.where("a0 is null").drop(*PARAMETERS)
