"""The release gate: ranking, breakdown and the promote-or-keep decision.

Every aggregate here is partial before its exchange, so a model that holds most
of the rows costs no more than one row per task on the wire.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladewerk.schema import CATEGORIES


def comparison_table(predictions: DataFrame) -> DataFrame:
    """Models ranked by exact share, then by field share. A null category is left
    out of the share but counted in n; a null duration is left out."""
    correct = F.when(F.col("category").isNotNull(), (F.col("category") == "CORRECT").cast("int"))
    return (
        predictions.groupBy("model_name", "version")
        .agg(
            (100 * F.avg(correct)).alias("pct_correct"),
            (100 * F.avg("field_accuracy")).alias("pct_fields"),
            F.count("*").alias("n"),
            F.avg("duration").cast("decimal(10,2)").alias("avg_seconds"),
        )
        .orderBy(
            F.desc("pct_correct"), F.desc("pct_fields"), F.asc("model_name"), F.asc("version")
        )
    )


def winner(predictions: DataFrame) -> DataFrame:
    return comparison_table(predictions).limit(1)


def category_position(category: Column) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), category)


def category_breakdown(predictions: DataFrame) -> DataFrame:
    """Counts per model in order of precedence; a missing category is OTHER, an
    unknown one is not reported."""
    known = F.coalesce(F.col("category"), F.lit("OTHER"))
    return (
        predictions.groupBy("model_name", known.alias("category"))
        # The position is an aggregate so that its filter stays above the grouping.
        .agg(F.count("*").alias("n"), F.max(category_position(known)).alias("_position"))
        .where(F.col("_position") > 0)
        .orderBy("model_name", "_position")
        .select("model_name", "category", "n")
    )


def _percent() -> Column:
    return F.try_divide(
        100.0 * F.count_if(F.col("category") == "CORRECT"), F.count("*").cast("double")
    )


def percent_correct(predictions: DataFrame, name: str = "pct_correct") -> DataFrame:
    """One row; every prediction counts, and no predictions make 0."""
    return predictions.agg(F.coalesce(_percent(), F.lit(0.0)).alias(name))


def outcome_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model_name", "version").agg(
        F.count_if(F.col("category") == "CORRECT").alias("n_correct"),
        F.count_if(F.col("category") == "ERROR").alias("n_error"),
        F.count("*").alias("n"),
    )


def _decision() -> Column:
    return (
        F.when(F.col("incumbent_pct").isNull(), "PROMOTED_BASELINE")
        .when(F.col("candidate_pct") > F.col("incumbent_pct"), "PROMOTED")
        .otherwise("KEPT")
    )


def gate_decision(candidate: DataFrame, incumbent: DataFrame | None) -> DataFrame:
    """One row: decision, candidate_pct, incumbent_pct. Only a strictly better
    candidate is promoted; with no incumbent any candidate is."""
    # Both sides are one-row aggregates of the same scan shape; they are put side
    # by side with a tagged union, so no join is planned.
    tagged = percent_correct(candidate).select("pct_correct", F.lit("candidate").alias("side"))
    if incumbent is not None:
        tagged = tagged.unionByName(
            percent_correct(incumbent).select("pct_correct", F.lit("incumbent").alias("side"))
        )

    def side(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("pct_correct")))

    both = tagged.agg(
        side("candidate").alias("candidate_pct"), side("incumbent").alias("incumbent_pct")
    )
    return both.select(_decision().alias("decision"), "candidate_pct", "incumbent_pct")


def gate_decisions(
    predictions: DataFrame, pairs: list[tuple[str, str | None]], column: str = "model_name"
) -> DataFrame:
    """candidate, decision, candidate_pct and incumbent_pct of each (candidate, incumbent)
    pair of models, by the rules of `gate_decision`; a pair may have no incumbent.

    The predictions are read and aggregated once, to one row per model; the pairs, which
    the caller lists, are then met with those rows.
    """
    spark = predictions.sparkSession
    shares = predictions.groupBy(F.col(column).alias("model")).agg(_percent().alias("pct"))
    rows = [(i, *pair) for i, pair in enumerate(pairs)]
    asked = spark.createDataFrame(rows, "pair int, candidate string, incumbent string")
    sides = asked.select(
        "*",
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("is_candidate"), F.col("candidate").alias("model")),
                F.struct(F.lit(False).alias("is_candidate"), F.col("incumbent").alias("model")),
            )
        ),
    )
    # A model without predictions has no row, and is right in no share of them.
    met = shares.join(F.broadcast(sides), "model", "right")
    pct = F.max(F.when(F.col("is_candidate"), F.coalesce("pct", F.lit(0.0))))
    old = F.max(F.when(~F.col("is_candidate") & F.col("model").isNotNull(), F.coalesce("pct", F.lit(0.0))))
    both = met.groupBy("pair", "candidate", "incumbent").agg(pct.alias("candidate_pct"), old.alias("incumbent_pct"))
    return both.select("candidate", _decision().alias("decision"), "candidate_pct", "incumbent_pct")
