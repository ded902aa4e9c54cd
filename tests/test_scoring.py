import random

import pytest
from conftest import FULL, line
from pyspark.sql import functions as F

from ladewerk.operators.scoring import attach_gold, is_accurate, score
from ladewerk.schema import CATEGORIES, LINE, LINE_FIELDS, LINES

E = [line(**FULL)]
A, B = line(quantity=1, rate=10), line(quantity=2, unit="skids", leg="delivery", rate=20)


def changed(**kw):
    return [line(**{**FULL, **kw})]


def scored(spark, rows):
    ddl = f"expected {LINES.simpleString()}, predicted {LINES.simpleString()}, error string"
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {ddl}")
    out = score(df).orderBy("i").collect()
    return [(r["category"], r["field_accuracy"]) for r in out]


CASES = [
    (E, E, None, "CORRECT"), (E, changed(rate="1847.50"), None, "CORRECT"), (E, E, "", "CORRECT"),
    (E, None, "boom", "ERROR"), (E, None, None, "ERROR"), (E, E, "boom", "ERROR"),
    (None, E, None, "ERROR"), (E, [line(unit=None)], None, "ERROR"), (E, [None], None, "ERROR"),
    (E, E + E, None, "EXTRA_ITEMS"), (E, [], None, "MISSING_ITEMS"), ([], E, None, "EXTRA_ITEMS"),
    ([], [], None, "CORRECT"), ([A, B], [B, A], None, "UNORDERED"),
    ([A, A, B], [A, B, B], None, "BAD_QUANTITY"),
    (E, changed(quantity=5, rate=1), None, "BAD_QUANTITY"), (E, changed(rate=1), None, "BAD_RATE"),
    (E, changed(reference="PO-9"), None, "BAD_REFERENCE"),
    (E, changed(reference=None), None, "BAD_REFERENCE"),
    (E, changed(pickup_day=15), None, "BAD_DATE"), (E, changed(pickup_year=2025), None, "BAD_DATE"),
    (E, changed(weight=1), None, "BAD_WEIGHT"), (E, changed(unit="skids"), None, "BAD_UNIT"),
    (E, changed(leg="delivery"), None, "BAD_LEG"), (E, changed(origin="DAL"), None, "OTHER"),
    (E, changed(accessorial=5), None, "OTHER"),
    (E, changed(weight=1, unit="skids"), None, "BAD_WEIGHT"),
]


def test_categories(spark):
    got = scored(spark, [c[:3] for c in CASES])
    wrong = [(c, g) for c, g in zip(CASES, got) if g[0] != c[3]]
    assert wrong == []
    assert {c[3] for c in CASES} == set(CATEGORIES)


def test_field_accuracy(spark):
    eight = [line(quantity=q) for q in range(1, 9)]
    wrong = [list(x) for x in eight]
    for k, f in ((0, "origin"), (1, "origin"), (2, "origin")):
        wrong[k][LINE_FIELDS.index(f)] = "X"
    flipped = [[*x] for x in eight]
    got = scored(
        spark,
        [
            (E, E, None), (E, [], None), ([], [], None), (E, None, None), (E, E + E, None),
            (E, changed(rate=1), None), (eight, [tuple(x) for x in wrong], None),
            (eight, [tuple(x) for x in flipped][:1], None),
        ],
    )
    assert [g[1] for g in got] == [1.0, 0.0, 1.0, 0.0, 0.5, 0.9167, 0.9688, 0.125]


def test_rounding_takes_the_even_neighbour(spark):
    # 3 of 96 fields are 0.03125: half-even gives 0.0312.
    gold = [line(quantity=q) for q in range(8)]
    other = line(
        origin="o", destination="d", quantity=99, unit="u", weight=1, pickup_day=1, pickup_month=1,
        pickup_year=1, leg="x", accessorial=1, rate=0, reference="r",
    )
    near = list(other)
    for f in ("quantity", "unit", "leg"):
        near[LINE_FIELDS.index(f)] = gold[0][LINE_FIELDS.index(f)]
    assert scored(spark, [(gold, [tuple(near)] + [other] * 7, None)])[0][1] == 0.0312


def test_json_text_input_and_missing_expected(spark):
    good = '[{"quantity": 1, "unit": "skids", "leg": "pickup", "rate": 2.0}]'
    df = spark.createDataFrame(
        [(good, good.replace("2.0", '"2"')), (good, '{"a": 1}'), ("[]", "[]"), (None, "[]")],
        "expected string, predicted string",
    )
    assert [r[0] for r in score(df).select("category").collect()] == ["CORRECT", "ERROR", "CORRECT", "ERROR"]
    only = spark.createDataFrame([("[]",), (good,)], "predicted string")
    assert [r[0] for r in score(only).select("category").collect()] == ["CORRECT", "EXTRA_ITEMS"]


def test_input_columns_are_kept_and_filters_work(spark):
    df = spark.createDataFrame([(1, "x", "[]", "[]")], "id int, note string, expected string, predicted string")
    out = score(df)
    assert out.columns == ["id", "note", "expected", "predicted", "category", "field_accuracy"]
    assert out.where(is_accurate(F.col("category"))).count() == 1


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_gold_stored_once(spark, limit):
    gold = spark.createDataFrame([("1", [A]), ("2", [A, B]), ("9", [])], f"id string, expected {LINES.simpleString()}")
    rows = [("1", "m", [A])] * 40 + [("2", "m", [B, A]), ("3", "m", [A])]
    raw = spark.createDataFrame(rows, f"id string, model_name string, predicted {LINES.simpleString()}")
    out = score(attach_gold(raw, gold, broadcast_bytes=limit))
    got = {(r["id"], r["category"]): r["n"] for r in out.groupBy("id", "category").agg(F.count("*").alias("n")).collect()}
    assert got == {("1", "CORRECT"): 40, ("2", "UNORDERED"): 1}


def test_few_but_long_gold_lists_are_not_broadcast(spark):
    long = spark.range(3).select(
        F.col("id").cast("string").alias("id"),
        F.transform(F.sequence(F.lit(1), F.lit(3000)), lambda i: F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(LINE.fields, A, strict=True)])).alias("expected"),
    )
    raw = spark.createDataFrame([("1", [A])] * 5, f"id string, predicted {LINES.simpleString()}")
    def joined(limit):
        out = attach_gold(raw, long, broadcast_bytes=limit)
        assert out.count() == 5
        return out._jdf.queryExecution().executedPlan().toString()

    assert "SortMergeJoin" in joined(100_000) and "SortMergeJoin" not in joined(100 << 20)


def brute_category(exp, pred):
    def field(x, f):
        return x[LINE_FIELDS.index(f)]

    if exp == pred:
        return "CORRECT"
    if len(exp) == len(pred):
        rest = list(pred)
        for e in exp:
            if e in rest:
                rest.remove(e)
        if not rest:
            return "UNORDERED"
    if len(pred) != len(exp):
        return "EXTRA_ITEMS" if len(pred) > len(exp) else "MISSING_ITEMS"
    checks = [("BAD_QUANTITY", ["quantity"]), ("BAD_REFERENCE", ["reference"]),
              ("BAD_DATE", ["pickup_day", "pickup_month", "pickup_year"]), ("BAD_WEIGHT", ["weight"]),
              ("BAD_UNIT", ["unit"]), ("BAD_LEG", ["leg"]), ("BAD_RATE", ["rate"])]
    for name, fields in checks:
        if any(field(a, f) != field(b, f) for a, b in zip(exp, pred) for f in fields):
            return name
    return "OTHER"


def test_against_brute_force(spark):
    rng = random.Random(5)

    def some_line():
        pick = lambda *v: rng.choice(v)
        return line(
            quantity=pick(1, 1, 2), unit=pick("skids", "skids", "pallets"), weight=pick(None, 1),
            pickup_month=pick(None, 3), leg=pick("pickup", "delivery"), rate=pick(1, 1, 2),
            reference=pick(None, "a"), origin=pick(None, "X"),
        )

    rows = []
    for _ in range(400):
        exp = [some_line() for _ in range(rng.randint(0, 3))]
        pred = list(exp) if rng.random() < 0.6 else [some_line() for _ in range(rng.randint(0, 3))]
        rng.shuffle(pred)
        if pred and rng.random() < 0.3:
            pred[0] = some_line()
        rows.append((exp, pred, None))
    got = scored(spark, rows)
    for (exp, pred, _), (category, accuracy) in zip(rows, got):
        assert category == brute_category(exp, pred)
        n = max(len(exp), len(pred))
        same = sum(x == y for a, b in zip(exp, pred) for x, y in zip(a, b))
        assert accuracy == (1.0 if n == 0 else round(same / (12 * n), 4))


def test_equal_texts_are_read_once_and_score_as_others_do(spark):
    good = '[{"quantity": 1, "unit": "skids", "leg": "pickup", "rate": 2}]'
    spaced = good.replace(": ", ":")
    rows = [(1, good, good), (2, good, spaced), (3, "not json", "not json"), (4, None, None), (5, None, good), (6, "[]", "[]"), (7, good, None)]
    out = score(spark.createDataFrame(rows, "id int, expected string, predicted string"))
    assert {r["id"]: (r["category"], r["field_accuracy"]) for r in out.collect()} == {
        1: ("CORRECT", 1.0), 2: ("CORRECT", 1.0), 3: ("ERROR", 0.0), 4: ("ERROR", 0.0), 5: ("ERROR", 0.0), 6: ("CORRECT", 1.0), 7: ("ERROR", 0.0),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "(predicted#" in plan and "= expected#" in plan
