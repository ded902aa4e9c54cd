"""Canonical JSON text of a line list: declaration order, nulls dropped,
numbers as numbers, one space after ',' and ':'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladewerk.functions.binding import as_column, built_once
from ladewerk.schema import LINE


def number_text(d: Column) -> Column:
    """A decimal without insignificant zeros: 1847.50 -> 1847.5, 4200.00 -> 4200."""
    # The decimals here always have a scale above zero, so the point is printed.
    return F.when(d == 0, "0").otherwise(F.rtrim(F.rtrim(d.cast("string"), F.lit("0")), F.lit(".")))


def _hex4(n: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))


def _escaped_char(c: Column) -> Column:
    code = F.ascii(c).cast("bigint")
    beyond = code - 0x10000
    pair = F.concat(
        _hex4(F.lit(0xD800) + F.floor(beyond / 1024)), _hex4(F.lit(0xDC00) + beyond % 1024)
    )
    out = F.when(c == '"', '\\"').when(c == "\\", "\\\\")
    for char, short in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = out.when(c == char, short)
    return (
        out.when((code >= 32) & (code < 128), c).when(code < 0x10000, _hex4(code)).otherwise(pair)
    )


def string_text(s: Column) -> Column:
    """A string as a JSON token in ASCII."""
    plain = F.concat(F.lit('"'), s, F.lit('"'))
    escaped = F.array_join(F.transform(F.split(s, ""), _escaped_char), "")
    return F.when(s.rlike(r"\A[ !#-\[\]-~]*\z"), plain).otherwise(
        F.concat(F.lit('"'), escaped, F.lit('"'))
    )


def _value_text(field: T.StructField, value: Column) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.when(value.isNotNull(), string_text(value))
    if isinstance(field.dataType, T.DecimalType):
        return number_text(value)
    return value.cast("string")


def line_json(line: Column) -> Column:
    # A null value makes its concat null, and array_join leaves nulls out.
    pairs = [
        F.concat(F.lit(f'"{f.name}": '), _value_text(f, line.getField(f.name)))
        for f in LINE.fields
    ]
    return F.concat(F.lit("{"), F.array_join(F.array(*pairs), ", "), F.lit("}"))


@built_once
def lines_json(lines: Column | str) -> Column:
    """`[{...}, {...}]`; null for a null list."""
    texts = F.transform(as_column(lines), line_json)
    return F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]"))


def items_json(lines: Column | str) -> Column:
    """The wrapped form `{"items": [...]}`."""
    return wrap_items(lines_json(lines))


def wrap_items(array_text: Column) -> Column:
    return F.concat(F.lit('{"items": '), array_text, F.lit("}"))
