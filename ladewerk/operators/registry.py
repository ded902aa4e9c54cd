"""The model registry and who answers a request."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladewerk.schema import REGISTRY

DEFAULT_MODEL = "newer"


def registry_table(
    spark: SparkSession, entries: Iterable[Mapping], default: str = DEFAULT_MODEL,
    env: Mapping[str, str] | None = None, env_prefix: str = "MODEL_BASE_",
) -> DataFrame:
    """One row per entry, in order; the variable <env_prefix><NAME> replaces its base."""
    env = os.environ if env is None else env
    rows = []
    for e in entries:
        name = e["name"]
        rows.append(
            (
                name, env.get(f"{env_prefix}{name.upper()}") or e["base"],
                e.get("generation", ""), e.get("label", name), e.get("note", ""),
                bool(e.get("has_adapter", False)), name == default,
            )
        )
    return spark.createDataFrame(rows, REGISTRY)


def resolve_models(
    requests: DataFrame, registry: DataFrame, default: str = DEFAULT_MODEL,
    requested: str = "model",
) -> DataFrame:
    """Adds requested_model, effective_model and fell_back.

    The registry is configuration made on the driver, a row per model, so it is
    broadcast; whether the default itself can answer is read from it once.
    """
    default_ready = (
        registry.where((F.col("name") == default) & F.col("has_adapter")).limit(1).count() > 0
    )
    known = registry.select(F.col("name").alias("_known"), F.col("has_adapter").alias("_ready"))
    asked = requests.withColumn(
        "requested_model", F.coalesce(F.nullif(F.col(requested), F.lit("")), F.lit(default))
    )
    joined = asked.join(F.broadcast(known), F.col("requested_model") == F.col("_known"), "left")
    to_default = F.col("_known").isNull() | (
        ~F.col("_ready") & F.lit(default_ready) & (F.col("requested_model") != default)
    )
    return joined.select(
        *[c for c in asked.columns],
        F.when(to_default, default).otherwise(F.col("requested_model")).alias("effective_model"),
        to_default.alias("fell_back"),
    )
