"""Batch extraction: a table of message texts to typed, guarded lines."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladewerk.functions.binding import computed
from ladewerk.functions.json_text import lines_json
from ladewerk.functions.reading import read_lines
from ladewerk.functions.text import prompt
from ladewerk.functions.validation import (
    guard_references, in_vocabulary, parse_items, reference_unsupported, sound_lines,
)
from ladewerk.operators.registry import DEFAULT_MODEL, resolve_models
from ladewerk.schema import LINES

MISSING_FIELD = "ValueError: a line lacks a required field"
BAD_OUTPUT = "ValueError: the output is not a list of shipment lines"


def _finish(df: DataFrame, kept: list[str], read: Column, error: Column, duration: Column) -> DataFrame:
    """items, reference_guarded, error, duration from the lines that were read; an
    error leaves no items."""
    ok = F.col("_error").isNull()
    text = F.col("text")
    got = computed(
        df, read.alias("_read"), error.alias("_given"), duration.alias("_seconds")
    ).select(
        "*",
        F.coalesce(
            "_given",
            F.when(F.col("_read").isNull(), BAD_OUTPUT),
            F.when(~sound_lines(F.col("_read")) | ~in_vocabulary(F.col("_read")), MISSING_FIELD),
        ).alias("_error"),
    )
    return computed(
        got, F.when(ok, guard_references(F.col("_read"), text)).alias("items")
    ).select(
        *kept,
        "items",
        F.when(ok, reference_unsupported(F.col("_read"), text)).alias("reference_guarded"),
        F.col("_error").alias("error"),
        F.when(ok, F.bround(F.col("_seconds"), 3)).alias("duration"),
    )


def extract(texts: DataFrame, rules: str = "full") -> DataFrame:
    """Rule extraction in built-in expressions. Rows take no measurable time of
    their own inside a stage, so `duration` is null."""
    return _finish(
        texts, texts.columns, read_lines("text", rules),
        F.lit(None).cast("string"), F.lit(None).cast("double"),
    )


def parse(
    requests: DataFrame, registry: DataFrame, rules_of: dict[str, str],
    default: str = DEFAULT_MODEL,
) -> DataFrame:
    """Answer requests (text and an optional `model`): items, effective_model,
    requested_model, fell_back, reference_guarded. `rules_of` gives the rule set of
    each model that can answer."""
    resolved = resolve_models(requests, registry, default)
    read = F.lit(None).cast(LINES)
    for model, rules in rules_of.items():
        read = F.when(F.col("effective_model") == model, read_lines("text", rules)).otherwise(read)
    return _finish(
        resolved, resolved.columns, read, F.lit(None).cast("string"), F.lit(None).cast("double")
    )


def _ask(
    model: Callable[[list[str]], list[str]], prompts: list[str]
) -> list[tuple[str | None, str | None, float]]:
    """Answer, failure and seconds of each prompt."""
    if not prompts:
        return []
    started = time.perf_counter()
    try:
        raw = list(model(prompts))
        if len(raw) != len(prompts):
            raise ValueError(f"{len(raw)} answers to {len(prompts)} prompts")
        if not all(isinstance(r, str) for r in raw):
            raise TypeError("an answer is not a text")
    except Exception as exc:
        if len(prompts) == 1:
            return [(None, f"{type(exc).__name__}: {exc}", time.perf_counter() - started)]
        half = len(prompts) // 2
        return _ask(model, prompts[:half]) + _ask(model, prompts[half:])
    took = (time.perf_counter() - started) / len(prompts)
    return [(r, None, took) for r in raw]


def extract_with(
    texts: DataFrame, model: Callable[[list[str]], list[str]], guidance: str | None = None
) -> DataFrame:
    """Extraction by a caller's model: `model` maps a batch of prompts to raw JSON
    texts `{"items": [...]}`. A batch that fails, or is answered with another number of
    texts or with something else than texts, is halved and tried again, so that one bad
    row costs only itself."""
    given = F.col(guidance) if guidance else F.lit(None).cast("string")
    prompted = texts.withColumn("_prompt", prompt(F.col("text"), given))
    schema = T.StructType(
        prompted.schema.fields
        + [
            T.StructField("_raw", T.StringType()),
            T.StructField("_failure", T.StringType()),
            T.StructField("_took", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The other columns pass as they are; only the prompts become Python values.
        for batch in batches:
            answers = _ask(model, batch.column("_prompt").to_pylist())
            new = [
                pa.array([a[i] for a in answers], kind)
                for i, kind in enumerate((pa.string(), pa.string(), pa.float64()))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], [*batch.schema.names, "_raw", "_failure", "_took"]
            )

    answered = prompted.mapInArrow(run, schema)
    return _finish(
        answered, texts.columns, parse_items("_raw"), F.col("_failure"), F.col("_took")
    )


def predictions(
    extracted: DataFrame, model_name: str | Column, version: str | Column
) -> DataFrame:
    """Raw prediction rows, credited to the requested model even if another one
    answered. `extracted` also carries id and expected."""
    def as_column(v: str | Column) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    failed = F.col("error").isNotNull()
    extra = {
        "effective_model": F.when(
            ~failed,
            F.col("effective_model") if "effective_model" in extracted.columns
            else as_column(model_name),
        ),
        "fell_back": F.when(
            ~failed,
            F.col("fell_back") if "fell_back" in extracted.columns else F.lit(False),
        ),
    }
    return extracted.select(
        F.col("id").cast("string").alias("id"),
        as_column(model_name).alias("model_name"),
        as_column(version).alias("version"),
        "text", "expected", F.col("items").alias("predicted"), "duration", "error",
        *[c.alias(n) for n, c in extra.items()],
    )


def items_text(df: DataFrame, column: str = "items") -> Column:
    return lines_json(column)
