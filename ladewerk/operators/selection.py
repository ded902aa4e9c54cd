"""Exact-size seeded selection without sorting the table or using one task.

A row's place in the seeded order is a hash of its id. The n-th place is found
by counting rows per hash range and narrowing to one range at a time; the split
is then a plain filter. Rows that share an id are told apart by their content,
and full copies, which are interchangeable, are taken by number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladewerk.functions.draws import order_key

_KEY_BITS = 60
_STEP_BITS = 15  # at most 32,768 counts reach the driver per step
_FEW_ROWS = 10_000  # so many keys may be brought to the driver
_COPIES_PER_ROW = 10_000
_WINDOW_KEYS = 500_000  # so many places near a cut may be brought to the driver


def half_even(x: float) -> int:
    return round(x)


@dataclass(frozen=True)
class Cut:
    """Rows with a key below `key` are in; of the `equal` ones at it, `remaining`."""

    key: int
    remaining: int
    equal: int


def _find_cut(keys: DataFrame, n: int) -> Cut:
    """Where the n-th smallest `k` lies; 1 <= n <= number of rows."""
    prefix, taken, equal = 0, 0, 0
    for shift in range(_KEY_BITS - _STEP_BITS, -1, -_STEP_BITS):
        inside = keys.where(F.shiftright("k", shift + _STEP_BITS) == prefix)
        counts = inside.groupBy(F.shiftright("k", shift).alias("b")).count().collect()
        for row in sorted(counts, key=lambda r: r["b"]):
            if taken + row["count"] >= n:
                prefix, equal = row["b"], row["count"]
                break
            taken += row["count"]
        if shift and equal <= _FEW_ROWS:
            rows = inside.where(F.shiftright("k", shift) == prefix).collect()
            few = sorted(r["k"] for r in rows)
            key = few[n - taken - 1]
            return Cut(key, n - taken - sum(k < key for k in few), few.count(key))
    return Cut(prefix, n - taken, equal)


def _content(columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def _content_key(df: DataFrame, seed: int) -> Column:
    return order_key(seed, _content(df.columns))


def seeded_place(
    df: DataFrame, seed: int, id_column: str = "id", tag: str = "", columns: list[str] | None = None
) -> Column:
    """Key of the seeded order: from the id, or from the content (of `columns`) without one."""
    return order_key(
        seed, F.lit(tag), F.coalesce(F.col(id_column).cast("string"), _content(columns or df.columns))
    )


def _window(rank: int, n: int) -> tuple[int, int] | None:
    """Between which keys the rank-th of n lies, but for about one chance in 10^9: places
    are uniform hashes. None if too many keys lie there to be brought to the driver."""
    share = rank / n
    spread = 6 * math.sqrt(share * (1 - share) / n) + 16 / n
    if 2 * spread * n > _WINDOW_KEYS:
        return None
    top = 1 << _KEY_BITS
    return max(0, int((share - spread) * top)), min(top, int((share + spread) * top))


def _place_of(rank: int, before: int, keys: list[tuple[int, int]]) -> int | None:
    """The key up to which just `rank` rows lie, of sorted (key, rows) and `before` rows
    ahead of them; None if there is none among them."""
    for key, rows in sorted(keys):
        before += rows
        if before >= rank:
            return key if before == rank else None
    return None


def find_places(
    rows: DataFrame, n_sampled: int, sample: int | None, n_kept: int, ranks: list[int]
) -> tuple[int | None, list[int]] | None:
    """(the last sample place that is taken, the places of `ranks`), in one pass.

    `rows` hold `_sample`, the place in the order that a sample of `sample` of `n_sampled`
    rows is taken by (null where a row is always kept), and `_place`, the place in the order
    of all n_kept rows that are kept. Where each cut lies is known beforehand to about a
    square root of the rows, so only the keys near it come to the driver, with those rows'
    other places, and counts of all else. None if a key is not found so (rows share it, or
    there are too many): it then takes narrowing step by step.
    """
    taken = _window(sample, n_sampled) if sample is not None else (0, 0)
    near = [_window(rank, n_kept) for rank in ranks]
    if taken is None or None in near:
        return None
    unsure = F.lit(False) if sample is None else F.coalesce(F.col("_sample").between(*taken), F.lit(False))
    out = F.lit(False) if sample is None else F.coalesce(F.col("_sample") > taken[1], F.lit(False))
    # How many windows begin at or before the place tells which stretch it lies in.
    edges = sorted({e for low, high in near for e in (low, high + 1)})
    stretch = F.lit(0)
    for edge in edges:
        stretch = stretch + (F.col("_place") >= edge).cast("int")
    at_cut = F.lit(False)
    for low, high in near:
        at_cut = at_cut | F.col("_place").between(low, high)
    kind = F.when(out, -2).when(unsure, -1).otherwise(stretch)
    counts = (
        rows.groupBy(
            kind.alias("kind"), F.col("_sample").isNotNull().alias("sampled"),
            F.when(unsure, F.col("_sample")).alias("s"),
            F.when(unsure | (~out & at_cut), F.col("_place")).alias("p"),
        ).count().collect()
    )
    last = None
    if sample is not None:
        before = sum(c["count"] for c in counts if c["sampled"] and c["kind"] >= 0)
        by_key: dict[int, int] = {}
        for c in counts:
            if c["kind"] == -1:
                by_key[c["s"]] = by_key.get(c["s"], 0) + c["count"]
        last = _place_of(sample, before, list(by_key.items()))
        if last is None:
            return None
    sure = [c for c in counts if c["kind"] >= 0]
    late = [(c["p"], c["count"]) for c in counts if c["kind"] == -1 and c["s"] <= last]
    places = []
    for rank, (low, high) in zip(ranks, near, strict=True):
        first = edges.index(low) + 1
        before = sum(c["count"] for c in sure if c["kind"] < first) + sum(k for p, k in late if p < low)
        keys = [(c["p"], c["count"]) for c in sure if c["p"] is not None and low <= c["p"] <= high]
        merged: dict[int, int] = {}
        for key, k in keys + [(p, k) for p, k in late if low <= p <= high]:
            merged[key] = merged.get(key, 0) + k
        places.append(_place_of(rank, before, list(merged.items())))
    return None if None in places else (last, places)


def seeded_split(
    df: DataFrame, n: int, seed: int, id_column: str = "id", tag: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(the first n rows, the others) in the seeded order of `df`.

    The same rows come out for any partitioning. `df` is scanned a few times, so
    it should be a stored table or cheap to recompute.
    """
    if n <= 0:
        return df.where(F.lit(False)), df
    if df.count() <= n:
        return df, df.where(F.lit(False))
    place = seeded_place(df, seed, id_column, tag)
    cut = _find_cut(df.select(place.alias("k")), n)
    if cut.remaining == cut.equal:
        return df.where(place <= cut.key), df.where(place > cut.key)

    # Several rows share the id at the cut: order them by content.
    content = _content_key(df, seed)
    tied = df.where(place == cut.key)
    inner = _find_cut(tied.select(content.alias("k")), cut.remaining)
    ahead = df.where((place < cut.key) | ((place == cut.key) & (content < inner.key)))
    behind = df.where((place > cut.key) | ((place == cut.key) & (content > inner.key)))
    if inner.remaining == inner.equal:
        return ahead.unionByName(tied.where(content == inner.key)), behind
    one = tied.where(content == inner.key).limit(1)
    return (
        ahead.unionByName(repeat_row(one, inner.remaining)),
        behind.unionByName(repeat_row(one, inner.equal - inner.remaining)),
    )


def repeat_row(one: DataFrame, times: int) -> DataFrame:
    """`one` row `times` over, spread over tasks in bounded chunks."""
    full, rest = divmod(times, _COPIES_PER_ROW)
    spark = one.sparkSession
    sizes = spark.range(full).select(F.lit(_COPIES_PER_ROW).alias("_size"))
    if rest:
        sizes = sizes.unionByName(spark.range(1).select(F.lit(rest).alias("_size")))
    # A single row, so broadcasting it is bounded.
    paired = sizes.withColumn("_on", F.lit(1)).join(
        F.broadcast(one.withColumn("_on", F.lit(1))), "_on"
    )
    return paired.select(
        *one.columns, F.explode(F.sequence(F.lit(1), "_size")).alias("_copy")
    ).select(*one.columns)


def sample_exact(df: DataFrame, n: int, seed: int, id_column: str = "id") -> DataFrame:
    """n rows without replacement; drawn from another order than the shuffle."""
    return seeded_split(df, n, seed, id_column, tag="sample")[0]


def in_seeded_order(df: DataFrame, seed: int, id_column: str = "id") -> DataFrame:
    """The shuffled table, for an ordered export."""
    # The source partition comes last so that a mass of equal rows does not have to
    # fall into one range.
    return df.orderBy(
        seeded_place(df, seed, id_column), _content_key(df, seed), F.spark_partition_id()
    )


def seeded_parts(
    df: DataFrame, seed: int, rows_per_part: int = 1_000_000, id_column: str = "id"
) -> DataFrame:
    """The shuffled table as numbered partitions of about `rows_per_part` rows, so that a
    writer's part files hold the seeded order one after another.

    The places are uniform hashes, so equal ranges of them are equal parts, and the rows go
    straight to the partition of their range; nothing is sampled. One counting pass, a count
    for each part, makes sure: if an id that very many rows share fills a range to more than
    twice its share, the ranges are taken from a sample of the rows instead, with the rows
    of one place spread by their contents.
    """
    place = seeded_place(df, seed, id_column)
    n = df.count()
    parts = max(1, min(math.ceil(n / rows_per_part), 1 << _STEP_BITS))
    part = F.shiftright((F.shiftright(place, _KEY_BITS - 30) * parts), 30).cast("int")
    most = df.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0] or 0
    if most > 2 * rows_per_part:
        return in_seeded_order(df, seed, id_column)
    keyed = df.select("*", place.alias("_place"), _content_key(df, seed).alias("_content"), part.alias("_part"))
    return keyed.repartitionById(parts, "_part").sortWithinPartitions("_place", "_content").select(*df.columns)


def fill_missing_ids(
    df: DataFrame, seed: int, prefix: str = "bench-", any_missing: bool | None = None
) -> DataFrame:
    """Rows without an id are named by their 0-based place in the seeded order; a caller
    who knows whether there are any saves a pass.

    The place is the number of rows in lower hash ranges (a few thousand counts)
    plus the rank inside the range. Rows with an id only count, one group per id,
    and copies are counted before they are ranked, so no task sees a mass of them.
    """
    unnamed = F.col("id").isNull()
    if any_missing is None:
        any_missing = df.where(unnamed).limit(1).count() > 0
    if not any_missing:
        return df
    place = seeded_place(df, seed).alias("_place")
    named_counts = df.where(~unnamed).select(place).groupBy("_place").agg(F.count("*").alias("_copies"))
    groups = df.where(unnamed).groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    ranked = (
        groups.select("*", place, F.lit(True).alias("_unnamed"))
        .unionByName(named_counts.withColumn("_unnamed", F.lit(False)), allowMissingColumns=True)
        .withColumn("_range", F.shiftright("_place", _KEY_BITS - _STEP_BITS))
    )
    totals = ranked.groupBy("_range").agg(F.sum("_copies").alias("n")).collect()
    offset, starts = 0, []
    for row in sorted(totals, key=lambda r: r["_range"]):
        starts.append((row["_range"], offset))
        offset += row["n"]
    # At most one row per range: 32,768.
    starts_df = df.sparkSession.createDataFrame(starts, "_range bigint, _start bigint")
    before = (
        Window.partitionBy("_range").orderBy("_place", *df.columns)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_start") + F.coalesce(F.sum("_copies").over(before), F.lit(0))
    placed = (
        ranked.join(F.broadcast(starts_df), "_range")
        .withColumn("_first", first)
        .where(F.col("_unnamed"))
    )
    last_chunk = F.floor((F.col("_copies") - 1) / _COPIES_PER_ROW)
    chunks = placed.select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("_chunk")
    ).repartition("_first", "_chunk")
    last = F.least(F.col("_copies"), (F.col("_chunk") + 1) * _COPIES_PER_ROW) - 1
    each = chunks.select(
        "*", F.explode(F.sequence(F.col("_chunk") * _COPIES_PER_ROW, last)).alias("_copy")
    )
    name = F.concat(F.lit(prefix), (F.col("_first") + F.col("_copy")).cast("string"))
    return df.where(~unnamed).unionByName(each.withColumn("id", name).select(*df.columns))
