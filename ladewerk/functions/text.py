"""Prompt text, queue previews and word search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladewerk.schema import INSTRUCTION

PREVIEW_LENGTH = 70


def strip(s: Column) -> Column:
    """All leading and trailing white space, not only blanks."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def prompt(text: Column, guidance: Column | None = None) -> Column:
    head = F.lit(INSTRUCTION)
    if guidance is not None:
        hint = F.when(F.length(guidance) > 0, F.concat(F.lit("\nHint: "), strip(guidance)))
        head = F.concat(head, F.coalesce(hint, F.lit("")))
    return F.concat(head, F.lit("\n\nConfirmation:\n"), text, F.lit("\n"))


def count_hint(n: Column) -> Column:
    return F.concat(
        F.lit("there are "),
        n.cast("string"),
        F.when(n == 1, " shipment in this message").otherwise(" shipments in this message"),
    )


def preview(text: Column) -> Column:
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.when(
        F.length(flat) > PREVIEW_LENGTH, F.concat(F.left(flat, F.lit(PREVIEW_LENGTH)), F.lit("…"))
    ).otherwise(flat)


def has_words(text: Column, query: str) -> Column:
    """Every word of the query occurs in the text, in any case."""
    found = F.lit(True)
    for word in query.split():
        found = found & F.contains(F.lower(text), F.lower(F.lit(word)))
    return found
