"""Register files in one pass: lines are told apart by record type and written by it; targets, rejects and checks read from there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrier.functions.scalars import strip
from terrier.operators import census
from terrier.sources.files import split_fields
from terrier.sources.sinks import store_kinds

#: Each kind of record: register and record type (None where a register has one only), by its name.
RECORDS = {f"{r}-{t}" if t else r: (r, t) for r, t in (*((r, str(t)) for r, n in (("FAB", 5), ("TER", 4)) for t in range(1, n + 1)), ("SOG", None), ("TIT", None))}
#: Under this name stands what is no record.
REJECTS = "reject"


def classified(lines: DataFrame) -> DataFrame:
    """lines(register, value, ...) with fields (split at bars, quotes undone), record, and the reason why a line is none.

    Reasons: unknown register, no type, unknown type, too few fields, too many fields. Nothing is dropped.
    """
    fields = F.col("fields")
    typed = [r for r in census.REGISTERS if any(t for k, t in RECORDS.values() if k == r)]
    kind = F.when(F.col("register").isin(*typed), F.concat_ws("-", "register", strip(F.get(fields, F.lit(5))))).otherwise(F.col("register"))
    size = F.size(fields)
    wanted = F.try_element_at(F.create_map(*[F.lit(x) for name, origin in RECORDS.items() for x in (name, len(census.layout(*origin)))]), F.col("kind"))
    reason = (
        F.when(~F.coalesce(F.col("register").isin(*census.REGISTERS), F.lit(False)), "unknown register")
        .when(F.col("register").isin(*typed) & (F.coalesce(strip(F.get(fields, F.lit(5))), F.lit("")) == ""), "no type")
        .when(F.col("wanted").isNull(), "unknown type")
        .when(size < F.col("wanted"), "too few fields")
        .when(size > F.col("wanted"), "too many fields")
    )
    # generators of one row: filters on what is told from the fields stay above them, so that each of these is told once
    known, split = lines, F.coalesce(split_fields("value"), F.array().cast("array<string>"))
    for name, told in (("fields", split), ("kind", kind), ("wanted", wanted), ("reason", reason)):
        known = known.select("*", F.inline(F.array(F.struct(told.alias(name)))))
    return known.withColumn("record", F.when(F.col("reason").isNull(), F.col("kind")).otherwise(REJECTS)).drop("kind", "wanted")


def store_split(lines: DataFrame, path: str) -> dict[str, int]:
    """Write classified lines, a folder for each kind of record and one for rejects, in one scan. Returns how many lines each register gave, and how many of them were rejected, as counted on the way.

    Columns that lines has beside register stay: value (the line), file name, line number. Fields are not stored, as lists of short
    texts cost more to write and to read than the split of a line.
    """
    seen = Observation("lines")
    counts = [F.count_if(F.col("register") == r).alias(r) for r in census.REGISTERS]
    rejects = [F.count_if((F.col("register") == r) & F.col("reason").isNotNull()).alias(f"{r} {REJECTS}") for r in census.REGISTERS]
    rows = classified(lines).observe(seen, F.count("*").alias("lines"), F.count_if(F.col("reason").isNotNull()).alias("rejects"), *counts, *rejects)
    store_kinds(rows.drop("fields"), path, "record")
    return dict(seen.get)


def stored(spark: SparkSession, path: str, record: str) -> DataFrame:
    """What store_split() wrote of one kind of record: only its folder is read. Kinds that never occurred give no rows."""
    return spark.read.parquet(path).where(F.col("record") == record)


def records(spark: SparkSession, path: str, record: str) -> DataFrame:
    """The named fields of one kind of record."""
    # a generator of one row, so that a line is split once for all its fields
    split = stored(spark, path, record).select(F.inline(F.array(F.struct(split_fields("value").alias("fields")))))
    return split.select(*[F.get("fields", F.lit(i)).alias(n) for i, n in enumerate(census.layout(*RECORDS[record]))])


def record_of(table: str) -> str:
    """The kind of record that a target table is made of."""
    return next(n for n, origin in RECORDS.items() if origin == census.ORIGINS[table])


def targets(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All target tables, each from its own folder of store_split()."""
    return {t: census.only_persons(census.project(records(spark, path, record_of(t)), t), t) for t in census.TARGETS}


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are no record of any kind, and why."""
    return stored(spark, path, REJECTS).drop("record")


def missing(record: Column | str = "record", fields: Column | str = "fields") -> Column:
    """The names of required fields that a record lacks, for records of any kind."""
    record = F.col(record) if isinstance(record, str) else record
    fields = F.col(fields) if isinstance(fields, str) else fields
    # places as data and not as code, which would be too long to be compiled for all kinds at once
    required = []
    for name, origin in RECORDS.items():
        wanted = [(i, n) for i, n in enumerate(census.layout(*origin)) if n not in census.optional(*origin)]
        required += [F.lit(name), F.array(*[F.struct(F.lit(i).alias("place"), F.lit(n).alias("name")) for i, n in wanted])]

    def blank(x: Column) -> Column:
        # what is blank stands before "!", which spares most fields the slower look
        return F.coalesce(x < "!", F.lit(True)) & (F.coalesce(strip(x), F.lit("")) == "")

    lacking = F.filter(F.try_element_at(F.create_map(*required), record), lambda r: blank(F.get(fields, r["place"])))
    return F.coalesce(F.transform(lacking, lambda r: r["name"]), F.array().cast("array<string>"))
