"""Line lists from JSON text, or null when the text is not a valid list.

`from_json` is both too strict (12.0 is no integer to it) and too lax (an object
becomes a one-element list, 7 becomes "7"), so the text is read as VARIANT and
each field is checked by the type it has in the JSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladewerk.functions.binding import as_column, built_once, once
from ladewerk.functions.json_text import lines_json
from ladewerk.schema import DECIMAL, LEGS, LINE, LINE_FIELDS, LINES, REQUIRED_FIELDS, UNITS

_VARIANT_LINES = "array<struct<%s>>" % ", ".join(f"{f}: variant" for f in LINE_FIELDS)
_INT_TEXT = r"^\s*[+-]?\d+(_\d+)*(\.0*)?\s*$"
_DECIMAL_TEXT = r"^\s*[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?\s*$"
_DECIMAL_DDL = DECIMAL.simpleString()


# One line as lines_json writes it, but for strings with escapes: fields in their order, the
# required ones there, every number within its type.
_STRING = r'"[ !#-\[\]-~]*+"'
_VALUE_TEXT = {
    T.StringType(): _STRING,
    T.LongType(): r"-?(?:0|[1-9]\d{0,17}+)",
    T.IntegerType(): r"-?(?:0|[1-9]\d{0,8}+)",
    DECIMAL: r"-?(?:0|[1-9]\d{0,17}+)(?:\.\d{1,18}+)?+",
}


# The same, as lines_json writes numbers: no sign of zero, no zeros at the end of a fraction.
_CANONICAL_TEXT = {
    T.StringType(): _STRING,
    T.LongType(): r"(?!-0)" + _VALUE_TEXT[T.LongType()],
    T.IntegerType(): r"(?!-0)" + _VALUE_TEXT[T.IntegerType()],
    DECIMAL: r"(?!-0(?!\.))-?(?:0|[1-9]\d{0,17}+)(?:\.\d{1,18}+(?<!0))?+",
}


def _plain_list_pattern(value_text: dict[T.DataType, str]) -> str:
    """A list of such lines; possessive throughout, so it takes no stack for a long one."""
    fields = ""
    for f in LINE.fields:
        # Fields before the first required one end with a comma, those after begin with one.
        pair = rf'"{f.name}": {value_text[f.dataType]}'
        if LINE_FIELDS.index(f.name) < LINE_FIELDS.index(REQUIRED_FIELDS[0]):
            fields += rf"(?:{pair}, )?+"
        elif f.name == REQUIRED_FIELDS[0]:
            fields += pair
        else:
            fields += rf"(?:, {pair})" + ("" if f.name in REQUIRED_FIELDS else "?+")
    line = rf"\{{{fields}\}}"
    return rf"\[(?:{line}(?:, {line})*+)?+\]"


PLAIN_LINES = _plain_list_pattern(_VALUE_TEXT)
_PLAIN_LIST = rf"\A{PLAIN_LINES}\z"
_CANONICAL_LIST = rf"\A{_plain_list_pattern(_CANONICAL_TEXT)}\z"


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")


def _as(v: Column, ddl: str) -> Column:
    return F.try_variant_get(v, "$", ddl)


def _decimal_of_text(s: Column, pattern: str) -> Column:
    cleaned = F.regexp_replace(s, r"[\s_]", "")
    return F.when(s.rlike(pattern), cleaned.try_cast(DECIMAL))


def _read_decimal(v: Column) -> Column:
    kind = _kind(v)
    return F.when(_is_number(kind), _as(v, _DECIMAL_DDL)).when(
        kind == "STRING", _decimal_of_text(_as(v, "string"), _DECIMAL_TEXT)
    )


def _read_integer(v: Column, target: T.DataType) -> Column:
    kind = _kind(v)
    number = _as(v, _DECIMAL_DDL)
    return (
        F.when(kind == "BIGINT", _as(v, "bigint"))
        .when(_is_number(kind), F.when(number == F.floor(number), number))
        .when(kind == "STRING", _decimal_of_text(_as(v, "string"), _INT_TEXT))
        .when(kind == "BOOLEAN", _as(v, "boolean").cast("int"))
        .try_cast(target)
    )


def _read_string(v: Column) -> Column:
    return F.when(_kind(v) == "STRING", _as(v, "string"))


def _read(field: T.StructField, v: Column) -> Column:
    if isinstance(field.dataType, T.DecimalType):
        return _read_decimal(v)
    if isinstance(field.dataType, T.StringType):
        return _read_string(v)
    return _read_integer(v, field.dataType)


def _absent(v: Column) -> Column:
    return v.isNull() | F.coalesce(_kind(v) == "VOID", F.lit(False))


def _typed_line(raw: Column) -> Column:
    return F.struct(*[_read(f, raw.getField(f.name)).alias(f.name) for f in LINE.fields])


def _sound_line(raw: Column, line: Column) -> Column:
    """Every required field was readable, every optional one readable or absent."""
    ok = raw.isNotNull()
    for f in LINE_FIELDS:
        readable = line.getField(f).isNotNull()
        ok = ok & (readable if f in REQUIRED_FIELDS else readable | _absent(raw.getField(f)))
    return ok


def lines_of_variant(v: Column) -> Column:
    raw = F.try_variant_get(v, "$", _VARIANT_LINES)
    pairs = F.transform(
        raw, lambda x: F.struct(x.alias("raw"), _typed_line(x).alias("line"))
    )
    checked = F.transform(
        pairs,
        lambda p: F.when(_sound_line(p.getField("raw"), p.getField("line")), p.getField("line")),
    )
    # The rejected lines are null by now; one of them rejects the list.
    return once(checked, lambda c: F.when(F.forall(c, lambda x: x.isNotNull()), c))


def whole_value(json_text: Column | str) -> Column:
    """The variant of a text that is one JSON value with a list in it and nothing else, or
    null; of a value without a list, what follows it is not always noticed.

    Parsing stops at the end of the first value, so the text is parsed in brackets: what
    follows it must then be no more than the closing one. A text that closes that bracket
    itself has a "]" beside that of its list, or none of a list before it. Only such a
    text is parsed in braces too, where a bracket closes nothing."""
    text = F.col(json_text) if isinstance(json_text, str) else json_text
    in_list = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v": '), text, F.lit("}")))
    closing = F.instr(text, "]")
    second = F.contains(F.substr(text, closing + 1), F.lit("]")) | (closing < F.instr(text, "["))
    value = F.when((closing > 0) & second, F.try_variant_get(in_object, "$.v", "variant")).otherwise(
        F.when(F.try_variant_get(in_list, "$[1]", "variant").isNull(), F.try_variant_get(in_list, "$[0]", "variant"))
    )
    return F.when(in_list.isNotNull(), value)


@built_once
def parse_lines(json_text: Column | str) -> Column:
    """array<LINE> of a JSON list, or null if any rule is broken.

    A list written the way lines_json writes it breaks none, which one regular expression
    tells; it is read in one pass. Any other text is checked field by field."""
    text = as_column(json_text)
    return F.when(text.rlike(_PLAIN_LIST), F.from_json(text, LINES)).otherwise(lines_of_variant(whole_value(text)))


@built_once
def canonical_lines(json_text: Column | str) -> Column:
    """What lines_json writes of the parsed text, or null if any rule is broken. A text that
    is written so already, which one regular expression tells, is left as it is."""
    text = as_column(json_text)
    return F.when(text.rlike(_CANONICAL_LIST), text).otherwise(lines_json(parse_lines(json_text)))


@built_once
def parse_items(json_text: Column | str) -> Column:
    """array<LINE> of `{"items": [...]}`, or null."""
    return lines_of_variant(F.try_variant_get(whole_value(json_text), "$.items", "variant"))


def is_valid_lines(json_text: Column | str) -> Column:
    return parse_lines(json_text).isNotNull()


def review_row_valid(parsed: str, corrected: str) -> Column:
    """The save-time rule: both labels must be sound, an absent correction is."""
    return is_valid_lines(parsed) & (F.col(corrected).isNull() | is_valid_lines(corrected))


def sound_lines(lines: Column) -> Column:
    """The same required-field rule for a list that is already typed."""
    def complete(x: Column) -> Column:
        ok = x.isNotNull()
        for f in REQUIRED_FIELDS:
            ok = ok & x.getField(f).isNotNull()
        return ok

    return lines.isNotNull() & F.forall(lines, complete)


def in_vocabulary(lines: Column) -> Column:
    """Closed unit and leg words, as the extractors must emit them."""
    return F.forall(
        lines, lambda x: x.getField("unit").isin(*UNITS) & x.getField("leg").isin(*LEGS)
    )


def date_ladder_ok(lines: Column) -> Column:
    """A day or a year is never stated without its month."""
    return F.forall(
        lines,
        lambda x: x.getField("pickup_month").isNotNull()
        | (x.getField("pickup_day").isNull() & x.getField("pickup_year").isNull()),
    )


def one_reference(lines: Column) -> Column:
    return F.size(F.array_distinct(F.transform(lines, lambda x: x.getField("reference")))) <= 1


def reference_unsupported(lines: Column, text: Column) -> Column:
    """Some line carries a reference that the text does not contain."""
    return F.exists(
        lines,
        lambda x: F.coalesce(~F.contains(text, x.getField("reference")), F.lit(False)),
    )


def guard_references(lines: Column | str, text: Column) -> Column:
    """Null each reference that is not a literal substring of the text."""
    return F.transform(
        as_column(lines),
        lambda x: x.withField(
            "reference",
            F.when(F.contains(text, x.getField("reference")), x.getField("reference")),
        ),
    )
