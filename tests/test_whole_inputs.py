"""Inputs that were once cut, changed or counted twice without a word."""

from __future__ import annotations

import json

import pytest
from ladewerk.functions.json_text import string_text
from ladewerk.functions.validation import is_valid_lines, parse_items
from ladewerk.operators.extract import extract_with
from ladewerk.operators.scoring import attach_gold
from ladewerk.session import spread, work_folder
from pyspark.sql import functions as F

LINE = '{"quantity": 3, "unit": "skids", "leg": "delivery", "rate": 2.16}'


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n", "\x85", " ", "\n\n", ""])
def test_a_final_line_end_is_escaped(spark, end):
    text = "PU 1 skids" + end
    out = spark.createDataFrame([(text,)], "t string").select(string_text(F.col("t"))).first()[0]
    assert json.loads(out) == text and out.isascii() and "\n" not in out


@pytest.mark.parametrize("tail", [" junk", f"[{LINE}]", "]", "}", f", [{LINE}]", ', "w": 1', "]]", '}, "v": []'])
def test_text_after_the_value_is_invalid(spark, tail):
    df = spark.createDataFrame([(f"[{LINE}]",)], "t string")
    row = df.select(
        is_valid_lines("t"), is_valid_lines(F.concat("t", F.lit(" \n"))), is_valid_lines(F.concat("t", F.lit(tail))),
        parse_items(F.concat(F.lit('{"items": '), "t", F.lit("}"))).isNotNull(),
        parse_items(F.concat(F.lit('{"items": '), "t", F.lit("}" + tail))).isNull(),
    ).first()
    assert tuple(row) == (True, True, False, True, True)


def test_a_model_s_bad_answers_cost_their_own_rows(spark):
    def model(prompts):
        out = ['{"items": []}' for p in prompts if "short" not in p]
        return [7 if "number" in p else r for p, r in zip(prompts, out, strict=False)] if len(out) == len(prompts) else out

    big = 2**53 + 1
    rows = [(big, "fine"), (None, "short"), (big + 1, "number"), (4, "fine")]
    texts = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    got = {(r["id"], r["text"]): r["error"] for r in extract_with(texts, model).collect()}
    assert set(got) == set(rows)
    assert got[(big, "fine")] is None and got[(4, "fine")] is None
    assert got[(None, "short")].startswith("ValueError") and got[(big + 1, "number")].startswith("TypeError")


def test_gold_rows_of_one_id_are_refused(spark):
    gold = spark.createDataFrame([("1", None), ("1", None), ("2", None)], "id string, expected array<string>")
    runs = spark.createDataFrame([("1",), ("2",)], "id string")
    with pytest.raises(ValueError, match="1 keys stand in several rows, such as 1"):
        attach_gold(runs, gold).collect()
    assert attach_gold(runs, gold.distinct()).count() == 2


def test_the_work_folder_needs_no_setting(spark):
    assert work_folder(spark) == work_folder(spark)


def test_spread_goes_by_rows_not_by_scan_tasks(spark, tmp_path):
    """Sixteen scan tasks, of which one holds nearly all rows."""
    spark.range(40_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    for i in range(15):
        spark.range(10).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    kept = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    try:
        table = spark.read.parquet(str(tmp_path / "t"))
        assert table.rdd.getNumPartitions() >= 8
        dealt = spread(table).groupBy(F.spark_partition_id().alias("t")).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", kept[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[1])
    assert dealt[1] == 40_150 and dealt[0] < 8_000
