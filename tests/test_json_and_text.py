import json
from decimal import Decimal

import pytest
from conftest import line
from pyspark.sql import functions as F

from ladewerk.functions.json_text import items_json, lines_json
from ladewerk.functions.text import count_hint, has_words, preview, prompt
from ladewerk.functions.validation import parse_items, parse_lines
from ladewerk.schema import INSTRUCTION, LINE_FIELDS, LINES


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def encode(spark, lines):
    df = spark.createDataFrame([(lines,)], f"lines {LINES.simpleString()}")
    return df.select(lines_json("lines").alias("v")).first()["v"]


def expected_json(lines):
    def number(d):
        return int(d) if d == d.to_integral_value() else float(d)

    rows = []
    for values in lines:
        row = {k: v for k, v in zip(LINE_FIELDS, values) if v is not None}
        rows.append({k: number(v) if isinstance(v, Decimal) else v for k, v in row.items()})
    return json.dumps(rows)


@pytest.mark.parametrize(
    "lines",
    [
        [],
        [line(rate="1847.50", weight=4200)],
        [line(rate="0"), line(rate="-12.05", accessorial="0.5", reference='say "hi" \\ / ')],
        [line(origin="Zürich", destination="東京", reference="tab\tnew\nline\x01 \U0001f69a")],
        [line(origin="", weight="100000", pickup_day=1, pickup_month=2, pickup_year=2025)],
    ],
)
def test_canonical_json_is_what_python_writes(spark, lines):
    assert encode(spark, lines) == expected_json(lines)


def test_null_list_stays_null(spark):
    assert encode(spark, None) is None


def test_round_trip_and_exact_decimals(spark):
    text = '{"items": [{"quantity":3,"unit":"skids","leg":"delivery","rate":2.16}]}'
    df = spark.createDataFrame([(text,)], "j string")
    got = df.select(parse_items("j").alias("v")).first()["v"]
    assert got[0]["rate"] == Decimal("2.16")
    again = df.select(parse_items("j").alias("v")).select(items_json("v")).first()[0]
    assert again == '{"items": [{"quantity": 3, "unit": "skids", "leg": "delivery", "rate": 2.16}]}'


def test_trailing_zeros_are_equal(spark):
    df = spark.createDataFrame(
        [('[{"quantity":1,"unit":"u","leg":"l","rate":%s}]' % r,) for r in ("1847.50", "1847.5")],
        "j string",
    )
    assert df.select(parse_lines("j").alias("v")).distinct().count() == 1


def test_prompt(spark):
    bare = f"{INSTRUCTION}\n\nConfirmation:\nhello\n"
    hinted = f"{INSTRUCTION}\nHint: there are 3 shipments\n\nConfirmation:\nhello\n"
    text = F.lit("hello")
    assert one(spark, prompt(text)) == bare
    assert one(spark, prompt(text, F.lit(None).cast("string"))) == bare
    assert one(spark, prompt(text, F.lit(""))) == bare
    assert one(spark, prompt(text, F.lit("\n there are 3 shipments\t"))) == hinted
    # White space alone is a hint, an empty one.
    assert one(spark, prompt(text, F.lit(" \n"))) == f"{INSTRUCTION}\nHint: \n\nConfirmation:\nhello\n"


def test_count_hint(spark):
    got = [r[0] for r in spark.range(3).select(count_hint(F.col("id"))).collect()]
    assert got == [
        "there are 0 shipments in this message", "there are 1 shipment in this message",
        "there are 2 shipments in this message",
    ]


def test_preview(spark):
    assert one(spark, preview(F.lit("a\nb"))) == "a b"
    assert one(spark, preview(F.lit("x" * 70))) == "x" * 70
    assert one(spark, preview(F.lit("x" * 71))) == "x" * 70 + "…"


def test_search_needs_every_word(spark):
    text = F.lit("PU 12 pallets from Chicago")
    assert one(spark, has_words(text, "pallets CHICAGO"))
    assert not one(spark, has_words(text, "pallets Dallas"))
