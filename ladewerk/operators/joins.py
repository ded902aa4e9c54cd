"""Joins to a side that holds each key once, safe for any skew of the other.

The unique side is measured in bytes and broadcast if it is small. Beyond that, a bitmap of
fixed size first tells which rows of the other side can have a partner at all; only those
are shuffled. The keys that hold very many of them are found by a sketch, and each is spread
over as many salts as its rows call for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
#: Words of 64 bits in the bitmap: at most so many rows of two numbers are broadcast.
WORDS = 1 << 18
#: A key of more rows than this is spread; the sketch tracks so many keys.
HOT_ROWS, HOT_KEYS, TRACKED = 200_000, 1_000, 10_000


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row's values take."""
    total = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0))
        else:
            total = total + 8
    return total


def unique_bytes(df: DataFrame, keys: list[str]) -> int:
    """How many bytes the rows of `df` take. Rows that share a key are an error, which
    names one; nulls share nothing."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("bytes"))
    named = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    twice = known & (F.col("n") > 1)
    seen = per_key.agg(F.sum("bytes").alias("bytes"), F.min(F.when(twice, named)).alias("twice"), F.count_if(twice).alias("n")).first()
    if seen["n"]:
        raise ValueError(f"{seen['n']} keys stand in several rows, such as {seen['twice']}")
    return seen["bytes"] or 0


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def partnered(left: DataFrame, right: DataFrame, keys: list[str], words: int = WORDS) -> DataFrame:
    """`left` with `_maybe`: whether its key can be in `right`, by a bitmap of its keys of
    `words` words of 64 bits, at most so many rows of two numbers."""
    word, bit = F.pmod(F.shiftright(_hash(keys), 6), F.lit(words)), F.pmod(_hash(keys), F.lit(64))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.cast("int"))
    bits = right.select(word.alias("_word"), one.alias("_one")).groupBy("_word").agg(F.bit_or("_one").alias("_bits"))
    looked = left.withColumn("_word", word).join(F.broadcast(bits), "_word", "left")
    maybe = F.coalesce(F.getbit("_bits", bit.cast("int")) == 1, F.lit(False))
    return looked.withColumn("_maybe", maybe).drop("_word", "_bits")


def hot_salts(rows: DataFrame, keys: list[str], hot_rows: int | None = None) -> list[tuple[int, int]]:
    """(key hash, salts) of the keys that hold more than hot_rows rows, by a sketch of
    fixed size that every task fills and that is merged."""
    limit = HOT_ROWS if hot_rows is None else hot_rows
    top = F.expr(f"approx_top_k(_h, {HOT_KEYS}, {TRACKED})")
    found = rows.select(_hash(keys).alias("_h")).agg(top.alias("top")).first()["top"]
    return [(r["item"], math.ceil(r["count"] / limit)) for r in found if r["count"] > limit]


def join_unique(
    left: DataFrame, right: DataFrame, keys: list[str], how: str,
    broadcast_bytes: int = BROADCAST_BYTES, right_bytes: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join `left` to `right`, whose keys are unique: inner, left or left_anti.

    `right_bytes` is for a caller who has measured the right side already.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"not a join to a unique side: {how}")
    if right_bytes is None:
        right_bytes = right.agg(F.sum(row_bytes(right))).first()[0] or 0
    if right_bytes <= broadcast_bytes:
        return left.join(F.broadcast(right), keys, how)
    looked = partnered(left, right, keys)
    able = looked.where("_maybe").drop("_maybe")
    salts = able.sparkSession.createDataFrame(hot_salts(able, keys, hot_rows), "_h bigint, _salts int")
    # At most HOT_KEYS rows.
    few = F.broadcast(salts)
    # The content and the source partition make the salt: equal rows spread too, and a task
    # that is run again gives its rows the same salts.
    spread = F.xxhash64(*left.columns) + F.spark_partition_id()
    n = F.coalesce("_salts", F.lit(1))
    salted = (
        able.withColumn("_h", _hash(keys)).join(few, "_h", "left")
        .withColumn("_salt", F.pmod(spread, n).cast("int")).drop("_h", "_salts")
    )
    repeated = (
        right.withColumn("_h", _hash(keys)).join(few, "_h", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_h", "_salts")
    )
    met = salted.join(repeated.hint("merge"), [*keys, "_salt"], how).drop("_salt")
    if how == "inner":
        return met
    alone = looked.where(~F.col("_maybe")).drop("_maybe")
    return met.unionByName(alone, allowMissingColumns=how == "left")
