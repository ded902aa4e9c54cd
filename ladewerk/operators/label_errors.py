"""Deliberate label errors for a review queue, and their classes in an audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladewerk.functions.binding import built_once
from ladewerk.functions.draws import below, chance, digest, draw
from ladewerk.functions.json_text import lines_json
from ladewerk.functions.validation import (
    date_ladder_ok, guard_references, in_vocabulary, one_reference, reference_unsupported,
    sound_lines,
)
from ladewerk.operators.scoring import same_lines_any_order
from ladewerk.schema import LINE_FIELDS

# --- fixed values -----------------------------------------------------------
KINDS = ["ordering", "missing", "hallucination", "mapping"]  # in order of claim
DROPPABLE = ["weight", "accessorial", "reference", "pickup_year", "pickup_month", "pickup_day"]
INVENTED_REFERENCE = "PO-HALLUCINATED-000000"
QUANTITY_SHIFT = 7
# --- end of fixed values ----------------------------------------------------


def _droppable(line: Column) -> Column:
    return F.coalesce(*[F.when(line.getField(f).isNotNull(), F.lit(f)) for f in DROPPABLE])


def _drop_first_value(line: Column) -> Column:
    field = _droppable(line)
    out = line
    for f in DROPPABLE:
        out = out.withField(f, F.when(field == f, None).otherwise(line.getField(f)))
    return out


def _change_at(lines: Column, position: Column, change) -> Column:
    return F.transform(
        lines, lambda x, i: F.when(i == position, change(x)).otherwise(x)
    )


def suitable(kind: str, lines: Column) -> Column:
    if kind == "ordering":
        return F.size(lines) >= 2
    if kind == "missing":
        return F.exists(lines, lambda x: _droppable(x).isNotNull())
    return F.size(lines) >= 1


@built_once
def corrupt(kind: str, lines: str) -> Column:
    """The list with the error of its kind; unchanged for a null kind."""
    kind, lines = F.col(kind), F.col(lines)
    has_value = F.transform(lines, lambda x: _droppable(x).isNotNull())
    first_with_value = F.array_position(has_value, True) - 1
    return (
        F.when(kind == "ordering", F.reverse(lines))
        .when(kind == "missing", _change_at(lines, first_with_value, _drop_first_value))
        .when(
            kind == "hallucination",
            _change_at(
                lines, F.lit(0), lambda x: x.withField("reference", F.lit(INVENTED_REFERENCE))
            ),
        )
        .when(
            kind == "mapping",
            _change_at(
                lines, F.lit(0),
                lambda x: x.withField("quantity", x.getField("quantity") + QUANTITY_SHIFT),
            ),
        )
        .otherwise(lines)
    )


def plan_first_suitable(seed_rows: DataFrame, position: str = "row_idx") -> dict[int, str]:
    """{row position: kind}: each kind claims the first suitable row not taken.

    A kind loses at most one row to each kind before it, so the four smallest suitable
    positions of each are enough. One pass finds them for all kinds: a task hands on at
    most four rows of a kind.
    """
    fitting = F.array_compact(F.array(*[F.when(suitable(k, F.col("gold")), F.lit(k)) for k in KINDS]))
    offered = seed_rows.select(F.col(position).alias("at"), F.explode(fitting).alias("kind"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy("at"))
    few = offered.withColumn("_place", place).where(F.col("_place") <= len(KINDS)).collect()
    plan: dict[int, str] = {}
    for kind in KINDS:
        free = sorted(r["at"] for r in few if r["kind"] == kind and r["at"] not in plan)
        if free:
            plan[free[0]] = kind
    return plan


def with_plan(seed_rows: DataFrame, plan: dict[int, str], position: str = "row_idx") -> DataFrame:
    """Adds `kind`; the plan holds at most four rows, so it is a CASE, not a join."""
    kind = F.lit(None).cast("string")
    for at, name in plan.items():
        kind = F.when(F.col(position) == at, name).otherwise(kind)
    return seed_rows.withColumn("kind", kind)


def with_fraction(
    seed_rows: DataFrame, permille: int, seed: int, position: str = "row_idx"
) -> DataFrame:
    """Adds `kind`: a seeded share of the rows, each with a suitable kind."""
    h = digest(seed, F.col(position), "corrupt")
    fitting = F.filter(
        F.array(*[F.when(suitable(k, F.col("gold")), F.lit(k)) for k in KINDS]),
        lambda k: k.isNotNull(),
    )
    return (
        seed_rows.select("*", fitting.alias("_fit"), h.alias("_h"))
        .withColumn(
            "kind",
            F.when(
                chance(draw(F.col("_h"), 0), permille) & (F.size("_fit") > 0),
                F.get("_fit", below(draw(F.col("_h"), 1), F.greatest(F.size("_fit"), F.lit(1)))
                      .cast("int")),
            ),
        )
        .drop("_fit", "_h")
    )


def review_rows(
    planned: DataFrame, *, auto_review: bool, now: Column, position: str = "row_idx"
) -> DataFrame:
    """Review rows of seed rows with a `kind`; corrupted ones are corrected back to
    gold when the queue is loaded as already reviewed."""
    hit = F.col("kind").isNotNull()
    # The first pk is 1.
    fixed = F.when(hit, lines_json("gold")) if auto_review else F.lit(None).cast("string")
    reviewed = now if auto_review else F.lit(None).cast("timestamp")
    changed = planned.select("*", corrupt("kind", "gold").alias("_bad"))
    return changed.select(
        (F.col(position) + 1).cast("bigint").alias("id"),
        "text",
        lines_json("_bad").alias("parsed"),
        fixed.alias("corrected"),
        reviewed.alias("reviewed"),
        F.lit(False).alias("exclude"),
        now.alias("created"),
    )


def load_report(planned: DataFrame) -> DataFrame:
    """Rows per injected error class; clean rows have a null kind."""
    return planned.groupBy("kind").agg(F.count("*").alias("n"))


def injected_errors(planned: DataFrame, position: str = "row_idx") -> DataFrame:
    """Which row shows which error class."""
    return planned.where(F.col("kind").isNotNull()).select(position, "id", "kind")


def _pair_states(proposed: Column, gold: Column) -> Column:
    """Per aligned pair: bit 1 a value gold lacks, bit 2 a value gold alone has,
    bit 4 two values that differ."""
    def state(p: Column, g: Column) -> Column:
        total = None
        for f in LINE_FIELDS:
            a, b = p.getField(f), g.getField(f)
            one = (
                F.when(a.eqNullSafe(b), 0).when(b.isNull(), 1).when(a.isNull(), 2).otherwise(4)
            )
            total = one if total is None else total.bitwiseOR(one)
        return total

    shared = F.least(F.size(proposed), F.size(gold))
    return F.zip_with(
        F.slice(proposed, F.lit(1), shared), F.slice(gold, F.lit(1), shared), state
    )


@built_once
def error_class(proposed: str, gold: str) -> Column:
    """How a proposed label is wrong: wrong-order, hallucinated, missing or
    wrong-mapping; null when it is right, INVALID when it has no sound lines."""
    proposed, gold = F.col(proposed), F.col(gold)
    states = F.aggregate(
        _pair_states(proposed, gold), F.lit(0), lambda acc, s: acc.bitwiseOR(s)
    )
    same_size = F.size(proposed) == F.size(gold)
    return (
        F.when(~F.coalesce(sound_lines(proposed), F.lit(False)), "INVALID")
        .when(proposed == gold, None)
        .when(same_size & same_lines_any_order(proposed, gold), "wrong-order")
        .when((states.bitwiseAND(1) != 0) | (F.size(proposed) > F.size(gold)), "hallucinated")
        .when((states.bitwiseAND(2) != 0) | (F.size(proposed) < F.size(gold)), "missing")
        .otherwise("wrong-mapping")
    )


def audit(labels: DataFrame) -> DataFrame:
    """Rule violations and error class of `proposed` against `gold` and `text`."""
    p = F.col("proposed")
    return labels.select(
        "id",
        error_class("proposed", "gold").alias("error_class"),
        (~date_ladder_ok(p)).alias("bad_date_ladder"),
        reference_unsupported(p, F.col("text")).alias("unsupported_reference"),
        (~one_reference(p)).alias("several_references"),
        (~in_vocabulary(p)).alias("outside_vocabulary"),
        lines_json(guard_references(p, F.col("text"))).alias("guarded"),
    )
