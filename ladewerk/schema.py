"""Table schemas and closed vocabularies, shared by every job.

Readers always get one of these schemas; nothing in the package infers one.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Money and weights are compared exactly, so they never pass through a float.
# 18 fractional digits are kept; more than 20 integer digits is invalid.
DECIMAL = T.DecimalType(38, 18)

LINE = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit", T.StringType()),
        T.StructField("weight", DECIMAL),
        T.StructField("pickup_day", T.IntegerType()),
        T.StructField("pickup_month", T.IntegerType()),
        T.StructField("pickup_year", T.IntegerType()),
        T.StructField("leg", T.StringType()),
        T.StructField("accessorial", DECIMAL),
        T.StructField("rate", DECIMAL),
        T.StructField("reference", T.StringType()),
    ]
)
LINES = T.ArrayType(LINE)
LINE_FIELDS = [f.name for f in LINE.fields]
REQUIRED_FIELDS = ["quantity", "unit", "leg", "rate"]

# --- fixed values -----------------------------------------------------------
UNITS = ["pallets", "skids", "cartons", "containers"]
LEGS = ["pickup", "delivery"]
# In order of precedence: the first that applies names the prediction.
CATEGORIES = [
    "ERROR", "CORRECT", "UNORDERED", "EXTRA_ITEMS", "MISSING_ITEMS",
    "BAD_QUANTITY", "BAD_REFERENCE", "BAD_DATE", "BAD_WEIGHT", "BAD_UNIT",
    "BAD_LEG", "BAD_RATE", "OTHER",
]
ACCURATE = ["CORRECT", "UNORDERED"]
INSTRUCTION = (
    "You are an API endpoint that only speaks in JSON. "
    "You will receive shipment confirmations as raw text and output parsed JSON. "
    "'PU' means pickup; 'DLV' and 'del' mean delivery."
)
# --- end of fixed values ----------------------------------------------------


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def _table(columns: str) -> T.StructType:
    # StructType.fromDDL needs a running session, which an import must not.
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SEED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("gold", LINES),
    ]
)
REVIEWS = _table(
    "id bigint, text string, parsed string, corrected string, "
    "reviewed timestamp, exclude boolean, created timestamp"
)
LABELLED = _table("id string, text string, parsed_json string")
EXAMPLES = _table("id string, text string, parsed_json string, style string, complexity int")
EXAMPLES_EXPORT = _table("id string, text string, parsed_json string, style string")
TRAIN = _table("instruction string, input string, output string")
BENCHMARK = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("expected", LINES),
    ]
)
PREDICTIONS_RAW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("expected", LINES),
        T.StructField("predicted", LINES),
        T.StructField("duration", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("effective_model", T.StringType()),
        T.StructField("fell_back", T.BooleanType()),
    ]
)
PREDICTIONS = T.StructType(
    PREDICTIONS_RAW.fields
    + [
        T.StructField("category", T.StringType()),
        T.StructField("field_accuracy", T.DoubleType()),
    ]
)
# The gate needs these five scalars and never reads the nested arrays.
GATE_COLUMNS = _table(
    "model_name string, version string, category string, duration double, field_accuracy double"
)
REGISTRY = _table(
    "name string, base string, generation string, label string, note string, "
    "has_adapter boolean, is_default boolean"
)
