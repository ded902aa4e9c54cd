from collections import Counter

import pytest
from pyspark.sql import functions as F

from ladewerk.functions.draws import order_key
from ladewerk.operators import joins, selection
from ladewerk.operators.contamination import exclude_texts
from ladewerk.operators.selection import (
    fill_missing_ids, in_seeded_order, repeat_row, sample_exact, seeded_parts, seeded_split,
)


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


@pytest.mark.parametrize("n", [0, 1, 150, 999, 1000, 5000])
def test_exact_sizes(spark, n):
    df = spark.range(1000)
    head, tail = seeded_split(df, n, seed=3)
    a, b = ids(head), ids(tail)
    assert len(a) == min(n, 1000)
    assert sorted(a + b) == list(range(1000))


def test_same_rows_for_any_partitioning(spark):
    df = spark.range(500)
    one = ids(seeded_split(df.coalesce(1), 75, seed=1)[0])
    many = ids(seeded_split(df.repartition(37), 75, seed=1)[0])
    assert one == many
    assert one != ids(seeded_split(df, 75, seed=2)[0])


def test_prefix_of_the_seeded_order(spark):
    df = spark.range(300)
    order = [r[0] for r in in_seeded_order(df, 9).collect()]
    assert order != sorted(order)
    for n in (10, 299):
        assert ids(seeded_split(df, n, seed=9)[0]) == sorted(order[:n])


def test_narrowing_through_every_level(spark, monkeypatch):
    monkeypatch.setattr(selection, "_FEW_ROWS", 0)
    df = spark.range(300)
    order = [r[0] for r in in_seeded_order(df, 9).collect()]
    assert ids(seeded_split(df, 123, seed=9)[0]) == sorted(order[:123])


def test_one_id_holding_most_rows(spark):
    rows = [("hot", f"text {k}") for k in range(200)] + [(f"id{k}", "t") for k in range(100)]
    df = spark.createDataFrame(rows, "id string, text string")
    for n in (5, 90, 150, 250):
        head, tail = seeded_split(df, n, seed=4)
        a, b = [tuple(r) for r in head.collect()], [tuple(r) for r in tail.collect()]
        assert len(a) == n
        assert Counter(a + b) == Counter(rows)


def test_full_copies_are_split_by_number(spark):
    rows = [("hot", "same")] * 200 + [(f"id{k}", "t") for k in range(100)]
    df = spark.createDataFrame(rows, "id string, text string")
    for n in (1, 120, 299):
        head, tail = seeded_split(df, n, seed=4)
        a, b = [tuple(r) for r in head.collect()], [tuple(r) for r in tail.collect()]
        assert len(a) == n
        assert Counter(a + b) == Counter(rows)


def test_repeat_row_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(selection, "_COPIES_PER_ROW", 7)
    one = spark.createDataFrame([("a", 1)], "id string, v int")
    assert Counter(tuple(r) for r in repeat_row(one, 23).collect()) == {("a", 1): 23}


def test_sample_is_another_order_than_the_shuffle(spark):
    df = spark.range(400)
    assert ids(sample_exact(df, 100, 1)) != ids(seeded_split(df, 100, 1)[0])


def test_missing_ids_are_named_by_place(spark, monkeypatch):
    monkeypatch.setattr(selection, "_COPIES_PER_ROW", 2)
    rows = [(f"k{i}" if i % 3 else None, f"text {i}") for i in range(30)] + [(None, "copy")] * 5
    df = spark.createDataFrame(rows, "id string, text string")
    order = [tuple(r) for r in in_seeded_order(df, 6).collect()]
    expected = Counter((i or f"bench-{p}", t) for p, (i, t) in enumerate(order))
    assert Counter(tuple(r) for r in fill_missing_ids(df, 6).collect()) == expected


def test_named_rows_are_left_alone(spark):
    df = spark.createDataFrame([("a", "t")], "id string, text string")
    assert fill_missing_ids(df, 0) is df


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_exclude_texts(spark, limit):
    pool = spark.createDataFrame(
        [(i, f"t{i % 10}") for i in range(100)] + [(1000, None), (1001, "T1"), (1002, "t1 ")],
        "id int, text string",
    )
    held = spark.createDataFrame([("t1",), ("t1",), ("t4",), (None,)], "text string")
    kept = exclude_texts(pool, held, broadcast_bytes=limit)
    assert kept.columns == ["id", "text"]
    want = sorted([i for i in range(100) if i % 10 not in (1, 4)] + [1000, 1001, 1002])
    assert ids(kept) == want
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    assert ("SortMergeJoin" in plan) == (limit == 0)
    assert "BroadcastNestedLoopJoin" not in plan and "Cartesian" not in plan
    assert exclude_texts(pool, held.where("false"), broadcast_bytes=limit).count() == 103


def test_half_the_pool_on_one_text(spark):
    """The hot text is spread by its count; what no held-out text can match is not shuffled."""
    pool = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    held = spark.range(0, 20_000, 50).select(F.concat(F.lit("t"), F.col("id") + 1).alias("text")).unionByName(spark.createDataFrame([("hot",)], "text string"))
    kept = exclude_texts(pool, held, broadcast_bytes=0, hot_rows=500)
    assert ids(kept) == [i for i in range(1, 20_000, 2) if i % 50 != 1]
    salts = joins.hot_salts(pool, ["text"], hot_rows=500)
    assert len(salts) == 1 and 18 <= salts[0][1] <= 22  # measured, not fixed
    looked = joins.partnered(pool, held, ["text"])
    able = looked.where("_maybe").count()
    assert 10_400 <= able < 10_800  # all that match, and few others


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_large_unique_sides_join_like_small_ones(spark, how):
    rows = [(k % 70 if k % 3 else None, f"r{k}") for k in range(600)] + [(7, "hot")] * 400
    left = spark.createDataFrame(rows, "k int, v string")
    right = spark.createDataFrame([(k, f"w{k}") for k in range(0, 90, 2)] + [(7, "w7"), (None, "no")], "k int, w string")
    plain = left.join(right, "k", how)
    found = joins.join_unique(left, right, ["k"], how, broadcast_bytes=0, hot_rows=50)
    assert found.columns == plain.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_windows_hold_the_cut(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 5 != 0, order_key(1, F.lit("s"), F.col("id"))).alias("_sample"), order_key(1, F.lit("p"), F.col("id")).alias("_place")
    )
    plain = [tuple(r) for r in rows.collect()]
    for sample, ranks in ((None, [1]), (None, [750, 4999]), (100, [1, 500, 1099]), (3999, [2500])):
        kept = 5000 if sample is None else 1000 + sample
        found = selection.find_places(rows, 4000, sample, kept, ranks)
        last = None if sample is None else sorted(s for s, _ in plain if s is not None)[sample - 1]
        places = sorted(p for s, p in plain if sample is None or s is None or s <= last)
        assert found == (last, [places[r - 1] for r in ranks])


def test_places_that_rows_share_are_left_to_narrowing(spark):
    rows = spark.range(100).select(F.lit(None).cast("bigint").alias("_sample"), F.when(F.col("id") < 50, order_key(1, F.lit("one"))).otherwise(order_key(1, F.col("id"))).alias("_place"))
    first = sum(r["_place"] < rows.first()["_place"] for r in rows.collect())
    assert selection.find_places(rows, 0, None, 100, [first + 20]) is None


def test_parts_hold_the_seeded_order(spark):
    df = spark.range(3000).withColumn("text", F.concat(F.lit("x"), "id"))
    parts = seeded_parts(df, 4, rows_per_part=250)
    assert parts.rdd.getNumPartitions() == 12
    sizes = [len(p) for p in parts.rdd.glom().collect()]
    assert max(sizes) < 500 and min(sizes) > 100
    assert [r["id"] for r in parts.collect()] == [r["id"] for r in in_seeded_order(df, 4).collect()]
    assert "rangepartitioning" not in parts._jdf.queryExecution().executedPlan().toString()
    # An id that most rows share would fill one part: its rows are spread by content.
    hot = df.withColumn("id", F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")))
    assert [tuple(r) for r in seeded_parts(hot, 4, rows_per_part=250).collect()] == [tuple(r) for r in in_seeded_order(hot, 4).collect()]
    assert seeded_parts(df.limit(0), 4).count() == 0
