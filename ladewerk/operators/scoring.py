"""Each prediction gets exactly one category and a field accuracy.

Both come from one pass over the aligned lines: per pair, a bit mask of the
fields that differ. The work is row-local, so scoring never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladewerk.functions.binding import built_once, computed, once
from ladewerk.functions.validation import parse_lines, sound_lines
from ladewerk.operators.joins import BROADCAST_BYTES, join_unique, unique_bytes
from ladewerk.schema import ACCURATE, LINE_FIELDS, LINES

# --- fixed values: field checks in order of precedence -----------------------
FIELD_CHECKS = [
    ("BAD_QUANTITY", ["quantity"]),
    ("BAD_REFERENCE", ["reference"]),
    ("BAD_DATE", ["pickup_day", "pickup_month", "pickup_year"]),
    ("BAD_WEIGHT", ["weight"]),
    ("BAD_UNIT", ["unit"]),
    ("BAD_LEG", ["leg"]),
    ("BAD_RATE", ["rate"]),
]
# --- end of fixed values ----------------------------------------------------

_BIT = {f: 1 << k for k, f in enumerate(LINE_FIELDS)}


def _pair_mask(a: Column, b: Column) -> Column:
    mask = None
    for f, bit in _BIT.items():
        # Null equals null, so both-absent is a match.
        differs = F.when(a.getField(f).eqNullSafe(b.getField(f)), 0).otherwise(bit)
        mask = differs if mask is None else mask + differs
    return mask


def difference_masks(expected: Column, predicted: Column) -> Column:
    """One bit mask per aligned pair, up to the shorter list."""
    shared = F.least(F.size(expected), F.size(predicted))
    return F.zip_with(
        F.slice(expected, F.lit(1), shared), F.slice(predicted, F.lit(1), shared), _pair_mask
    )


def _any_bits(masks: Column) -> Column:
    return F.aggregate(masks, F.lit(0), lambda acc, m: acc.bitwiseOR(m))


def _matches(masks: Column) -> Column:
    return F.aggregate(masks, F.lit(0), lambda acc, m: acc + len(LINE_FIELDS) - F.bit_count(m))


def same_lines_any_order(expected: Column, predicted: Column) -> Column:
    """Equal as multisets: nested nulls sort and compare as values."""
    return F.array_sort(expected) == F.array_sort(predicted)


@built_once
def compare(expected: str, predicted: str, error: str | None) -> Column:
    """struct(usable, differing, matches) of two line lists."""
    error = F.col(error) if error else F.lit(None).cast("string")
    expected, predicted = F.col(expected), F.col(predicted)
    # An empty error text is no error.
    usable = (
        (F.coalesce(F.length(error), F.lit(0)) == 0)
        & sound_lines(expected) & sound_lines(predicted)
    )
    # Most predictions equal their gold; the pairwise pass is for the others.
    masks = F.when(
        expected == predicted, F.array_repeat(F.lit(0), F.size(expected))
    ).otherwise(difference_masks(expected, predicted))
    return once(
        F.when(usable, masks),
        lambda m: F.struct(
            m.isNotNull().alias("usable"),
            _any_bits(m).alias("differing"),
            _matches(m).alias("matches"),
        ),
    )


@built_once
def category_of(comparison: str, expected: str, predicted: str) -> Column:
    comparison, expected, predicted = F.col(comparison), F.col(expected), F.col(predicted)
    n_exp, n_pred = F.size(expected), F.size(predicted)
    bits = comparison.getField("differing")
    out = (
        F.when(~comparison.getField("usable"), "ERROR")
        .when((n_exp == n_pred) & (bits == 0), "CORRECT")
        .when((n_exp == n_pred) & same_lines_any_order(expected, predicted), "UNORDERED")
        .when(n_pred > n_exp, "EXTRA_ITEMS")
        .when(n_pred < n_exp, "MISSING_ITEMS")
    )
    for name, fields in FIELD_CHECKS:
        out = out.when(bits.bitwiseAND(sum(_BIT[f] for f in fields)) != 0, name)
    return out.otherwise("OTHER")


@built_once
def accuracy_of(comparison: str, expected: str, predicted: str) -> Column:
    comparison, expected, predicted = F.col(comparison), F.col(expected), F.col(predicted)
    n_lines = F.greatest(F.size(expected), F.size(predicted))
    return (
        F.when(~comparison.getField("usable"), 0.0)
        .when(n_lines == 0, 1.0)
        .otherwise(comparison.getField("matches") / (n_lines * len(LINE_FIELDS)))
    )


def _is_text(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, T.StringType)


def _typed(df: DataFrame, name: str) -> Column:
    return parse_lines(name) if _is_text(df, name) else F.col(name)


def score(raw: DataFrame) -> DataFrame:
    """`raw` with category and field_accuracy; `expected` and `predicted` may be
    line arrays or JSON text, and `expected` may be missing (an empty list)."""
    expected = _typed(raw, "expected") if "expected" in raw.columns else F.array().cast(LINES)
    sides = ("_expected", "_predicted")
    error = "error" if "error" in raw.columns else None
    predicted = _typed(raw, "predicted")
    if _is_text(raw, "expected") and _is_text(raw, "predicted"):
        # Equal texts are read once.
        raw_typed = computed(raw, expected.alias("_expected"))
        same = F.col("predicted") == F.col("expected")
        typed = computed(raw_typed, F.when(same, F.col("_expected")).otherwise(predicted).alias("_predicted"))
    else:
        typed = computed(raw, expected.alias("_expected"), predicted.alias("_predicted"))
    return computed(typed, compare(*sides, error).alias("_cmp")).select(
        *raw.columns,
        category_of("_cmp", *sides).alias("category"),
        F.bround(accuracy_of("_cmp", *sides), 4).alias("field_accuracy"),
    )


def attach_gold(
    predicted: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Predictions by id with the `expected` lines of a benchmark stored once. Gold rows
    that share an id are an error: they would count a prediction twice. One pass over the
    benchmark looks for such ids and measures the bytes that would be broadcast."""
    gold = benchmark.select("id", "expected")
    return join_unique(predicted, gold, ["id"], "inner", broadcast_bytes, unique_bytes(gold, ["id"]))


def attach_bucketed(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """The same for two stored tables in equally many buckets of the id, whose gold ids are
    known to be unique (see stores.BucketedStore): bucket meets bucket, nothing is shuffled."""
    return predicted.join(gold.select("id", "expected").hint("merge"), "id")


def is_accurate(category: Column) -> Column:
    return category.isin(*ACCURATE)
