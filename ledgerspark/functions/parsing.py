"""Parsing of delimited lines and typed values, as column expressions.

A typed parser returns (value, error): blanks and what the format does not
recognise are null; what looks right but can't be stored has an error, so the
row goes to quarantine instead of losing the value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]+"
MARK = "\ue000"


def utrim(c: Column) -> Column:
    """Without Unicode white space and byte-order marks at either end."""
    return F.regexp_replace(c, f"^{BLANKS}|{BLANKS}$", "")


def text(c: Column) -> Column:
    return F.nullif(utrim(c), F.lit(""))


#: Blanks other than the space, or a space where a field may begin or end.
ODD = r"[\t\n\x0B\f\r\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"


def texts(fields: Column, line: Column) -> Column:
    """text() of each field; a line that has no blanks but spaces needs no pattern for each."""
    return F.when(line.rlike(ODD), F.transform(fields, text)).otherwise(F.transform(fields, lambda x: F.nullif(F.trim(x), F.lit(""))))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once, wherever body has it."""
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with more columns, each computed once a row.

    A generator of one row stands between the columns and what uses them: the
    optimizer would otherwise put the whole expression wherever a later
    projection or a filter names its column, and a filter on a column of
    a column of a split line then splits it hundreds of times.
    """
    values = F.struct(*[v.alias(k) for k, v in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(values)))


def split_line(line: Column) -> Column:
    """Fields between semicolons. A quote opens or closes quoting anywhere in a field, two within quotes are one.

    The line is cut at its quotes: odd pieces are quoted; an empty even piece
    between two others is a doubled quote; in other even pieces semicolons end
    fields. The mark that stands for these is escaped where a line has it.
    """
    safe = F.replace(F.replace(line, F.lit("\\"), F.lit("\\\\")), F.lit(MARK), F.lit("\\m"))
    unquoted = lambda pieces: F.array_join(
        F.transform(pieces, lambda x, i: F.when(i % 2 == 1, x).when((x == "") & (i > 0) & (i < F.size(pieces) - 1), F.lit('"')).otherwise(F.replace(x, F.lit(";"), F.lit(MARK)))), ""
    )
    joined = bound(F.split(safe, '"', -1), unquoted)
    fields = F.split(F.when(line.contains('"'), joined).otherwise(F.replace(safe, F.lit(";"), F.lit(MARK))), MARK, -1)
    escaped = line.contains("\\") | line.contains(MARK)
    # a line without quotes and marks, as most are, is cut as it is
    return F.when(line.contains('"') | escaped, bound(fields, lambda f: F.when(escaped, F.transform(f, _unescape)).otherwise(f))).otherwise(F.split(line, ";", -1))


def _unescape(x: Column) -> Column:
    """\\\\m to the mark and two backslashes to one, each escape by itself."""
    return F.array_join(F.transform(F.split(x, r"\\\\", -1), lambda p: F.replace(p, F.lit("\\m"), F.lit(MARK))), "\\")


def fit_fields(fields: Column, expected: int) -> tuple[Column, Column]:
    """(fields of the expected number or null, error). Blank fields beyond go, missing ones are empty."""
    beyond = F.slice(fields, expected + 1, F.greatest(F.size(fields) - expected, F.lit(0)))
    ok = F.forall(beyond, lambda x: utrim(x) == "")
    padded = F.concat(F.slice(fields, 1, expected), F.array_repeat(F.lit(""), F.greatest(F.lit(expected) - F.size(fields), F.lit(0))))
    return F.when(ok, padded), F.when(~ok, F.concat(F.lit("Unexpected field count: "), F.size(fields).cast("string"), F.lit(f" instead of {expected}.")))


def numeric(c: Column, trimmed: bool = False) -> tuple[Column, Column]:
    """1.234,56 and 1234,56 and 1234.56; two decimals."""
    t = c if trimmed else text(c)
    plain = F.when(t.contains(","), F.replace(F.when(t.contains("."), F.replace(t, F.lit("."), F.lit(""))).otherwise(t), F.lit(","), F.lit("."))).otherwise(t)
    value = plain.try_cast("decimal(18,2)")
    return value, F.when(t.isNotNull() & value.isNull(), F.concat(F.lit("Invalid numeric value: "), t))


def integer(c: Column, trimmed: bool = False) -> tuple[Column, Column]:
    t = c if trimmed else text(c)
    return F.when(t.rlike("^-?[0-9]+$"), t.try_cast("bigint")), F.lit(None).cast("string")


def date(c: Column, trimmed: bool = False) -> tuple[Column, Column]:
    """yyyymmdd; zeros are null, other formats too; impossible days have an error."""
    t = c if trimmed else text(c)
    shaped = t.rlike("^[0-9]{8}$") & (t != "00000000")
    value = F.when(shaped, F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)).try_cast("date"))
    value = F.when(F.year(value) >= 1, value)
    return value, F.when(shaped & value.isNull(), F.concat(F.lit("Invalid date value: "), t))


def boolean(c: Column, trimmed: bool = False) -> tuple[Column, Column]:
    t = F.lower(c if trimmed else utrim(c))
    # What stands for true and false.
    return F.when(t.isin("1", "true", "t", "y", "yes", "s"), True).when(t.isin("0", "false", "f", "n", "no"), False), F.lit(None).cast("string")


PARSERS = {"text": lambda c, trimmed=False: (c if trimmed else text(c), F.lit(None).cast("string")), "integer": integer, "numeric": numeric, "date": date, "boolean": boolean}


def classify(message: Column) -> Column:
    """struct(category, retryable) of an error message; the first that matches."""
    m = F.lower(message)
    # Parts of messages, their categories and whether a later try may help.
    known = (
        ("invalid byte sequence for encoding", "invalid_utf8_sequence", True), ("violates not-null constraint", "not_null_violation", False),
        ("violates foreign key constraint", "foreign_key_violation", False), ("field count", "invalid_field_count", True), ("transform", "transform_error", True),
    )
    category, retryable = F.lit("unknown"), F.lit(False)
    for part, name, again in reversed(known):
        category, retryable = F.when(m.contains(part), name).otherwise(category), F.when(m.contains(part), again).otherwise(retryable)
    return F.struct(category.alias("category"), retryable.alias("retryable"))


def cnpj_full(root: Column, order: Column, digits: Column) -> Column:
    return F.concat(root, order, digits)


def dedupe_key(columns: list[Column], entry_date: int | None = None) -> Column:
    """MD5 of the columns, joined by |; missing ones are empty; a date is its distance from 2000-01-01 in days."""
    parts = [F.datediff(c, F.lit("2000-01-01").cast("date")).cast("string") if i == entry_date else c.cast("string") for i, c in enumerate(columns)]
    return F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in parts]).cast("binary"))


def placeholder(table: str, code: Column) -> Column:
    from ..model import PLACEHOLDERS

    return F.concat(F.lit(PLACEHOLDERS[table] + " ("), code, F.lit(")"))


def display_path(path: Column) -> Column:
    """parent > file"""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.concat(F.element_at(parts, -2), F.lit(" > "), F.element_at(parts, -1))).otherwise(path)


# What text in a COPY file writes for these characters; the backslash comes first.
COPY_ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\f", "\\f"), ("\b", "\\b"), ("\v", "\\v"))


def copy_text(c: Column, kind: str = "text") -> Column:
    """A value as a field of a COPY text file; missing ones are \\N, true and false t and f."""
    value = F.when(c, "t").otherwise("f") if kind == "boolean" else c.cast("string")
    if kind == "text":
        for plain, escaped in COPY_ESCAPES:
            value = F.replace(value, F.lit(plain), F.lit(escaped))
    return F.when(c.isNull(), F.lit("\\N")).otherwise(value)


def without_nul(c: Column) -> tuple[Column, Column]:
    """(text without NUL characters, how many there were)."""
    clean = F.translate(c, "\x00", "")
    return clean, (F.length(c) - F.length(clean)).cast("long")
