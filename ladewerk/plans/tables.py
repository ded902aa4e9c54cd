"""Confirmations, predictions, reviews and label pools derived row by row from
order, event, document and conversation tables.

One order is one confirmation. Its legs come from the order's own columns, so
nothing is joined or collected and any single customer or day may be as large as
it likes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladewerk.functions.binding import built_once, computed
from ladewerk.functions.draws import below, choose, draws
from ladewerk.functions.json_text import lines_json
from ladewerk.operators.generate import CHARGES, PLACES, write_message
from ladewerk.schema import DECIMAL, LINE, LINES, UNITS
from ladewerk.session import spread

LONG_EVERY, LONG_LINES = 16, 8
# Per model: how many of a hundred predictions are left as they should be.
RIGHT_PERCENT = {"older": 55, "newer": 75, "production": 92}
PREDICTION_KINDS = [
    "error", "reversed", "extra", "missing", "quantity", "reference", "date", "weight",
    "unit", "leg", "rate", "origin", "blank_error", "broken",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def _order_line(i: Column) -> Column:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate")
    pickup = i == 0
    shape = cust % 4  # none, month, month and day, full date
    codes = [code for code, _ in PLACES]
    cents = F.floor(F.col("o_totalprice") * 100 + 0.5).cast("bigint")
    values = {
        "origin": F.when((key + i) % 7 != 0, choose(codes, (cust + i) % 10)),
        "destination": F.when((key + i) % 7 > 1, choose(codes, (cust + i + 1) % 10)),
        "quantity": 1 + (key + 3 * i) % 40,
        "unit": choose(UNITS, (cust + i) % 4),
        "weight": F.when((cust + i) % 3 != 0, (5 + (key + i) % 416) * 100),
        "pickup_day": F.when(pickup & (shape >= 2), F.dayofmonth(day)),
        "pickup_month": F.when(pickup & (shape >= 1), F.month(day)),
        "pickup_year": F.when(pickup & (shape == 3), F.year(day)),
        "leg": F.when(pickup, "pickup").otherwise("delivery"),
        "accessorial": F.when((key + i) % 5 == 0, choose(CHARGES, (key + i) % 8)),
        "rate": ((cents + i).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")),
        "reference": F.when(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
            F.concat(F.lit("PO-"), (1000 + key).cast("string")),
        ),
    }
    return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in LINE.fields])


def _positions() -> Column:
    short = 1 + F.col("o_custkey") % 4
    n_lines = F.when(F.col("o_orderkey") % LONG_EVERY == 0, LONG_LINES).otherwise(short)
    return F.sequence(F.lit(0).cast("bigint"), (n_lines - 1).cast("bigint"))


@built_once
def _order_lines() -> Column:
    return F.transform(_positions(), _order_line)


def confirmations(orders: DataFrame) -> DataFrame:
    """id, text, gold and the order's status, one row per order."""
    key = F.col("o_orderkey")
    with_lines = computed(orders, _order_lines().alias("gold"))
    styled = with_lines.select(
        "*",
        F.transform(_positions(), lambda i: draws("text", key, i)).alias("_p"),
        draws("text", key, "row").alias("_r"),
    ).select(
        "*",
        F.when(F.size("gold") > 1, "multileg")
        .otherwise(choose(["terse", "verbose", "abbrev"], below(F.col("_r")[0], 3)))
        .alias("style"),
        F.get("gold", F.lit(0)).getField("reference").alias("_reference"),
    )
    return styled.select(
        key.alias("id"),
        write_message(
            lines="gold", phrase_draws="_p", row_draws="_r", style="style",
            reference="_reference",
        ).alias("text"),
        "gold", "o_orderstatus", "o_orderdate",
    )


def _first_line(lines: Column, **changes) -> Column:
    def change(x: Column) -> Column:
        for name, f in changes.items():
            x = x.withField(name, f(x.getField(name)))
        return x

    return F.transform(lines, lambda x, i: F.when(i == 0, change(x)).otherwise(x))


@built_once
def _predicted(kind: str, gold: str) -> Column:
    kind, gold = F.col(kind), F.col(gold)
    other = lambda a, b: lambda v: F.when(v == a, b).otherwise(a)
    plus = lambda n: lambda v: (F.coalesce(v, F.lit(0)) + n).cast(DECIMAL)
    return (
        F.when(kind == "error", F.lit(None).cast(LINES))
        .when(kind == "reversed", F.reverse(gold))
        .when(kind == "extra", F.concat(gold, F.slice(gold, 1, 1)))
        .when(kind == "missing", F.slice(gold, F.lit(2), F.size(gold)))
        .when(kind == "quantity", _first_line(gold, quantity=lambda v: v + 7))
        .when(kind == "reference", _first_line(gold, reference=lambda v: F.lit("PO-0")))
        .when(
            kind == "date",
            _first_line(gold, pickup_month=lambda v: (1 + F.coalesce(v, F.lit(0)) % 12)),
        )
        .when(kind == "weight", _first_line(gold, weight=plus(100)))
        .when(kind == "unit", _first_line(gold, unit=other("pallets", "skids")))
        .when(kind == "leg", _first_line(gold, leg=other("pickup", "delivery")))
        .when(kind == "rate", _first_line(gold, rate=plus(1)))
        .when(kind == "origin", _first_line(gold, origin=lambda v: F.lit("Tulsa")))
        .when(kind == "broken", _first_line(gold, unit=lambda v: F.lit(None).cast("string")))
        .otherwise(gold)
    )


def predictions(confirmed: DataFrame, version: str = "v1") -> DataFrame:
    """Raw predictions of three models: gold, disturbed by a draw per row."""
    per_model = confirmed.select(
        "id", "text", "gold", F.explode(F.array(*[F.lit(m) for m in RIGHT_PERCENT])).alias("model_name")
    )
    drawn = computed(per_model, draws("predict", F.col("id"), F.col("model_name")).alias("_d"))
    d = F.col("_d")
    right = F.lit(0)
    for model, percent in RIGHT_PERCENT.items():
        right = F.when(F.col("model_name") == model, percent).otherwise(right)
    kinds = drawn.withColumn(
        "_kind",
        F.when(below(d[0], 100) < right, "right").otherwise(
            choose(PREDICTION_KINDS, below(d[1], len(PREDICTION_KINDS)))
        ),
    )
    kind = F.col("_kind")
    return kinds.select(
        F.col("id").cast("string").alias("id"), "model_name", F.lit(version).alias("version"), "text",
        F.col("gold").alias("expected"),
        _predicted("_kind", "gold").alias("predicted"),
        F.when(kind != "error", below(d[2], 3000) / 1000.0).alias("duration"),
        F.when(kind == "error", "TimeoutError: no answer").when(kind == "blank_error", "")
        .alias("error"),
        F.when(kind != "error", F.col("model_name")).alias("effective_model"),
        F.when(kind != "error", F.lit(False)).alias("fell_back"),
    )


def event_log(events: DataFrame) -> DataFrame:
    """Scored prediction scalars from an event stream table: type as model, value
    as duration; some categories are missing or unknown."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_type").alias("model_name"),
        F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string")).alias("version"),
        F.when(k % 10 < 6, "CORRECT").when(k % 10 == 6, "ERROR").when(k % 10 == 7, "BAD_RATE")
        .when(k % 10 == 8, "NOT_A_CATEGORY").alias("category"),
        F.when(k % 10 != 6, F.col("value")).alias("duration"),
        (k / 100.0).alias("field_accuracy"),
    )


BROKEN_LABELS = [
    '{"not": "a list"}', "null", "[null]", "[1]", '[{"unit": "skids", "leg": "pickup"}]',
    '[{"quantity": 12.5, "unit": "skids", "leg": "pickup", "rate": 1}]',
    '[{"quantity": 1, "unit": 7, "leg": "pickup", "rate": 1}]',
    '[{"quantity": 1, "unit": "skids", "leg": "pickup", "rate": "1,847.50"}]',
    '[{"quantity": 1, "unit": "skids", "leg": null, "rate": 2}]', "not json",
]
LAX_LABEL = '[{"quantity": "12", "unit": "skids", "leg": "pickup", "rate": "2.50", "note": 1}]'


def reviews(confirmed: DataFrame) -> DataFrame:
    """The review queue: the order's status is the review state. One row in
    eleven has a broken auto-parse; some have a correction, which may be empty."""
    gold_json = lines_json("gold")
    key = F.col("id")
    broken = choose(BROKEN_LABELS, below(F.floor(key / 11), len(BROKEN_LABELS)))
    stamp = F.when(F.col("o_orderstatus").isin("F", "P"), F.col("o_orderdate"))
    return confirmed.select("*", gold_json.alias("_gold_json")).select(
        "id", "text",
        F.when(key % 11 == 0, broken).when(key % 13 == 0, LAX_LABEL)
        .otherwise(F.col("_gold_json")).alias("parsed"),
        F.when(key % 17 == 0, "[]").when(key % 5 == 0, F.col("_gold_json")).alias("corrected"),
        stamp.alias("reviewed"),
        (F.col("o_orderstatus") == "P").alias("exclude"),
        F.col("o_orderdate").alias("created"),
    )


def text_pool(documents: DataFrame, *, real: bool) -> DataFrame:
    """Documents as labelled rows: every fifth is real, the others synthetic. The
    label is a small list that follows from the id."""
    key = F.col("doc_id")
    label = F.concat(
        F.lit('[{"quantity": '), (1 + key % 40).cast("string"),
        F.lit(', "unit": "pallets", "leg": "pickup", "rate": 100}]'),
    )
    two = F.concat(
        F.lit('[{"quantity": 1, "unit": "skids", "leg": "pickup", "rate": 1}, '), F.substring(label, F.lit(2), F.length(label)),
    )
    rows = documents.where((key % 5 == 0) if real else (key % 5 != 0))
    return rows.select(
        F.concat(F.lit("doc-"), key.cast("string")).alias("id"), "text",
        F.when(key % 3 == 0, two).otherwise(label).alias("parsed_json"),
        *([] if real else [F.col("source").alias("style")]),
    )
