from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ladewerk.operators import gate

DDL = "model_name string, version string, category string, duration double, field_accuracy double"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def test_ranking_and_null_rules(spark):
    df = frame(
        spark,
        [
            ("a", "v1", "CORRECT", 1.0, 1.0), ("a", "v1", "BAD_RATE", 2.0, 0.5),
            ("a", "v1", None, None, 1.0), ("b", "v1", "CORRECT", None, 0.9),
            ("b", "v1", "ERROR", None, 0.0), ("c", "v1", "ERROR", None, 0.0),
        ],
    )
    rows = [tuple(r) for r in gate.comparison_table(df).collect()]
    assert rows == [
        ("a", "v1", 50.0, pytest.approx(100 * 2.5 / 3), 3, Decimal("1.50")),
        ("b", "v1", 50.0, 45.0, 2, None),
        ("c", "v1", 0.0, 0.0, 1, None),
    ]
    assert gate.winner(df).first()["model_name"] == "a"


def test_breakdown_order_and_vocabulary(spark):
    df = frame(
        spark,
        [("m", "v", c, None, None) for c in ("OTHER", "BAD_RATE", "ERROR", None, "NO_SUCH", "ERROR")],
    )
    rows = [tuple(r) for r in gate.category_breakdown(df).collect()]
    assert rows == [("m", "ERROR", 2), ("m", "BAD_RATE", 1), ("m", "OTHER", 2)]


def test_percent_counts_rows_without_category(spark):
    df = frame(spark, [("m", "v", c, None, None) for c in ("CORRECT", None, "ERROR", "CORRECT")])
    assert gate.percent_correct(df).first()[0] == 50.0
    assert gate.percent_correct(df.where(F.lit(False))).first()[0] == 0.0


@pytest.mark.parametrize(
    "candidate,incumbent,decision",
    [
        (["CORRECT"], None, "PROMOTED_BASELINE"), (["ERROR"], None, "PROMOTED_BASELINE"),
        (["CORRECT"], ["CORRECT"], "KEPT"), (["CORRECT", "ERROR"], ["ERROR"], "PROMOTED"),
        (["ERROR"], ["CORRECT"], "KEPT"), ([], ["ERROR"], "KEPT"), (["CORRECT"], [], "PROMOTED"),
    ],
)
def test_decision(spark, candidate, incumbent, decision):
    def rows(categories):
        return frame(spark, [("m", "v", c, None, None) for c in categories])

    old = None if incumbent is None else rows(incumbent)
    assert gate.gate_decision(rows(candidate), old).first()["decision"] == decision


def test_counts(spark):
    df = frame(spark, [("m", "v", c, None, None) for c in ("CORRECT", "ERROR", "ERROR", None)])
    assert tuple(gate.outcome_counts(df).first()) == ("m", "v", 1, 2, 4)


def test_decisions_of_many_pairs_are_those_of_each(spark):
    rows = [("a", "CORRECT"), ("a", "ERROR"), ("a", None), ("b", "CORRECT"), ("d", "ERROR")]
    p = spark.createDataFrame(rows, "model_name string, category string")
    pairs = [("a", "b"), ("b", "a"), ("b", "b"), ("a", None), ("none", None), ("none", "d"), ("a", "none"), ("b", "a"), ("d", "none")]
    found = sorted((tuple(r) for r in gate.gate_decisions(p, pairs).collect()), key=str)
    expected = []
    for candidate, incumbent in pairs:
        old = None if incumbent is None else p.where(F.col("model_name") == incumbent)
        expected.append((candidate, *gate.gate_decision(p.where(F.col("model_name") == candidate), old).first()))
    assert found == sorted(expected, key=str)
