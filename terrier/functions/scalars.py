"""Scalar functions: white space, safe casts, number texts, dates, accents, ids and URL parts. All are JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space around a value.
BLANKS = " \t\r\n\x0b\x0c"
ACCENTED, PLAIN = "àáâäèéêëìíîïòóôöùúûüçñÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜÇÑ", "aaaaeeeeiiiioooouuuucnAAAAEEEEIIIIOOOOUUUUCN"


def strip(c: Column | str) -> Column:
    """Without white space at both ends, tabs and carriage returns included."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS))


def clean_marker(c: Column | str) -> Column:
    """A stripped marker line without its trailing backslashes."""
    return F.rtrim(strip(c), F.lit("\\"))


# A failed cast is an exception inside, which costs far more than a look at the text's shape. So texts are cast only if their
# shape is that of a number; what is then still out of range is rare.
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _cast(text: Column, shape: str, kind: str) -> Column:
    return F.when(text.rlike(shape), text.try_cast(kind))


def safe_int(c: Column | str, default: int | None = None) -> Column:
    """The whole number in a text; default for anything else (fractions, digit groups, blanks, numbers out of range)."""
    out = _cast(strip(c), _WHOLE, "int")
    return out if default is None else F.coalesce(out, F.lit(default))


def safe_long(c: Column | str) -> Column:
    return _cast(strip(c), _WHOLE, "long")


def safe_decimal(c: Column | str) -> Column:
    return _cast(strip(c), _NUMBER, "decimal(18,3)")


def decimal_text(c: Column | str) -> Column:
    """A decimal of three places as text with at least one and at most three decimals."""
    cut = F.rtrim((F.col(c) if isinstance(c, str) else c).cast("decimal(18,3)").cast("string"), F.lit("0"))
    return F.concat(cut, F.when(cut.endswith("."), "0").otherwise(""))


def float_text(c: Column | str) -> Column:
    """The number in a text, as text with at least one and at most three decimals, never with an exponent; null for anything else."""
    return decimal_text(safe_decimal(c))


def whole_part(c: Column | str) -> Column:
    """The whole part of a number in a text, cut towards zero; null for anything else, infinite and very large numbers among it."""
    return _cast(strip(c), _NUMBER, "double").try_cast("int")


def act_date(c: Column | str, pattern: str = "ddMMyyyy") -> Column:
    """The date in a text of that pattern; null for blanks, zeros and days that don't exist."""
    return F.try_to_date(strip(c), pattern)


def fold_accents(c: Column | str) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def legacy_text(c: Column | str, encoding: str = "ISO-8859-1") -> Column:
    """The text in a column of bytes: UTF-8 where they are that, the older encoding otherwise. Accents of either kind come out alike."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.decode(c, encoding))


def surrogate_id(*parts: Column | str) -> Column:
    """MD5 of the key's parts, null parts as empty: the same on every run, without a shuffle."""
    columns = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", *columns))


def url_parts(c: Column | str) -> dict[str, Column]:
    """host, port, bucket (the host) and key (the path with its leading slash) of an address; null where it has none."""
    port = F.regexp_extract(c, r"^[^/?#]*//[^/?#]*:([0-9]+)(?:[/?#]|$)", 1).try_cast("int")
    return {"host": F.try_parse_url(c, F.lit("HOST")), "port": port, "bucket": F.try_parse_url(c, F.lit("HOST")), "key": F.try_parse_url(c, F.lit("PATH"))}


def doubled(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c) * 2
