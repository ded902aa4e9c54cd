"""The review table: trusted labels, queue views and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladewerk.functions.binding import computed
from ladewerk.functions.text import has_words, preview
from ladewerk.functions.validation import canonical_lines, review_row_valid


def trusted(reviews: DataFrame) -> DataFrame:
    """Signed off by a reviewer and not flagged as junk."""
    return reviews.where(F.col("reviewed").isNotNull() & (F.col("exclude") == F.lit(False)))


def training_label() -> Column:
    """A correction wins over the auto-parse, even an empty one."""
    return F.coalesce(F.col("corrected"), F.col("parsed"))


def checked_labels(reviews: DataFrame) -> DataFrame:
    """id, text, parsed_json of each trusted row; parsed_json is null when the
    label breaks the schema."""
    chosen = trusted(reviews).select("id", "text", training_label().alias("label"))
    return computed(chosen, canonical_lines("label").alias("parsed_json")).select(
        F.col("id").cast("string").alias("id"), "text", "parsed_json"
    )


def trusted_labels(reviews: DataFrame) -> DataFrame:
    return checked_labels(reviews).where(F.col("parsed_json").isNotNull())


def export_counts(reviews: DataFrame) -> DataFrame:
    return checked_labels(reviews).agg(
        F.count("parsed_json").alias("written"),
        F.count_if(F.col("parsed_json").isNull()).alias("skipped"),
    )


def with_validity(reviews: DataFrame) -> DataFrame:
    """The save-time check of both labels."""
    return reviews.withColumn("valid", review_row_valid("parsed", "corrected"))


def queue(
    reviews: DataFrame, *, corrected: str | None = None, reviewed: bool | None = None,
    exclude: bool | None = None, search: str = "",
) -> DataFrame:
    """The queue list with its facets; `corrected` is "yes", "no" or anything else
    for all."""
    out = reviews
    if corrected in ("yes", "no"):
        has = F.col("corrected").isNotNull()
        out = out.where(has if corrected == "yes" else ~has)
    if reviewed is not None:
        done = F.col("reviewed").isNotNull()
        out = out.where(done if reviewed else ~done)
    if exclude is not None:
        out = out.where(F.col("exclude") == F.lit(exclude))
    if search.strip():
        out = out.where(has_words(F.col("text"), search))
    return out.select(
        "id", preview(F.col("text")).alias("short_text"), "reviewed",
        F.col("corrected").isNotNull().alias("has_correction"), "exclude",
    )


def next_unreviewed(reviews: DataFrame, after: int) -> DataFrame:
    """One row: the next id to review after `after`, wrapping to the first; null
    when nothing is left."""
    open_ids = reviews.where(F.col("reviewed").isNull())
    return open_ids.agg(
        F.coalesce(F.min(F.when(F.col("id") > after, F.col("id"))), F.min("id")).alias("next_id")
    )
