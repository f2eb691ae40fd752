"""Checks as columns: a reason where a value breaks a rule, null where it doesn't. Rows are never dropped here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.scalars import strip

# What each coded field may hold.
MAPPA = ("MAPPA", "MAPPA FONDIARIO", "QUADRO D'UNIONE")
SECTIONS = ("A", "B", "C", "D")
ANNEXES = ("0", "Q", "A", "B", "D")
DEVELOPMENTS = ("A", "B", "C", "D", "0", "U")


def mappa_reason(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.coalesce(c.isin(*MAPPA), F.lit(False)), "value")


def code_reason(c: Column | str, allowed: tuple[str, ...]) -> Column:
    """len for anything but one character, value for a character that isn't allowed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.coalesce(F.length(c) != 1, F.lit(True)), "len").when(~c.isin(*allowed), "value")


def check_sheets(sheets: DataFrame) -> DataFrame:
    """With a reason for each coded field of a sheet's name and header."""
    return sheets.withColumns(
        {
            "mappa_reason": mappa_reason("mappa"),
            "section_reason": code_reason("codice_sezione_censuaria", SECTIONS),
            "annex_reason": code_reason("codice_allegato", ANNEXES),
            "development_reason": code_reason("codice_sviluppo", DEVELOPMENTS),
        }
    )


def fab_file_ok(register: Column | str, ext: Column | str) -> Column:
    """Whether a file of the buildings' register has that register's extension."""
    register, ext = (F.col(c) if isinstance(c, str) else c for c in (register, ext))
    return F.coalesce((register == "FAB") & (ext == "FAB"), F.lit(False))


def missing_fields(required: list[str]) -> Column:
    """The names of required fields that are null or empty."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c)) for c in required]))


def missing_of(fields: Column | str, names: list[str], optional: frozenset[str]) -> Column:
    """The same for fields by place: names of those that are absent or blank, without the optional ones."""
    return F.array_compact(F.array(*[F.when(F.coalesce(strip(F.get(fields, F.lit(i))), F.lit("")) == "", F.lit(n)) for i, n in enumerate(names) if n not in optional]))


def quarantine(rows: DataFrame, reasons: dict[str, str], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and a row (keys, rule, reason, value) for each broken rule. reasons: reason column by the column that it is about."""
    bad = F.array_compact(F.array(*[F.when(F.col(r).isNotNull(), F.struct(F.lit(r).alias("rule"), F.col(r).alias("reason"), F.col(c).cast("string").alias("value"))) for c, r in reasons.items()]))
    marked = rows.withColumn("_bad", bad)
    broken = marked.where(F.size("_bad") > 0).select(*keys, F.explode("_bad").alias("b")).select(*keys, "b.*")
    return marked.where(F.size("_bad") == 0).drop("_bad"), broken
