import datetime as dt

import pytest
from conftest import FULL, line
from pyspark.sql import functions as F

from ladewerk.functions.json_text import lines_json
from ladewerk.operators import label_errors as LE
from ladewerk.operators import review
from ladewerk.operators.scoring import score
from ladewerk.schema import LINES, REVIEWS

DAY = dt.datetime(2026, 1, 1)
LABEL = '[{"quantity": 2, "unit": "pallets", "leg": "pickup", "rate": %s}]'


def rows(spark, *specs):
    base = {"text": "some text", "parsed": LABEL % "1847.50", "corrected": None, "reviewed": None,
            "exclude": False, "created": DAY}
    return spark.createDataFrame(
        [tuple({**base, "id": i, **s}[f] for f in REVIEWS.fieldNames()) for i, s in enumerate(specs, 1)],
        REVIEWS,
    )


def test_export_selection(spark):
    df = rows(
        spark, {"reviewed": DAY}, {"reviewed": DAY, "corrected": LABEL % "2000.00"},
        {"reviewed": DAY, "exclude": True}, {}, {"reviewed": DAY, "corrected": "[]"},
        {"reviewed": DAY, "parsed": "{}"}, {"reviewed": DAY, "parsed": "{}", "corrected": LABEL % 1},
        {"reviewed": DAY, "corrected": "null"},
    )
    got = [tuple(r) for r in review.trusted_labels(df).select("id", "parsed_json").orderBy("id").collect()]
    assert got == [("1", LABEL % "1847.5"), ("2", LABEL % "2000"), ("5", "[]"), ("7", LABEL % "1")]
    assert tuple(review.export_counts(df).first()) == (4, 2)


def test_nothing_reviewed(spark):
    df = rows(spark, {}, {})
    assert review.trusted_labels(df).count() == 0
    assert tuple(review.export_counts(df).first()) == (0, 0)


def test_queue_facets(spark):
    df = rows(
        spark, {"text": "a\nb"}, {"corrected": "[]", "reviewed": DAY}, {"exclude": True, "text": "Big TRUCK"},
    )

    def ids(**kw):
        return sorted(r["id"] for r in review.queue(df, **kw).collect())

    assert ids() == ids(corrected="all") == [1, 2, 3]
    assert (ids(corrected="yes"), ids(corrected="no")) == ([2], [1, 3])
    assert (ids(reviewed=True), ids(reviewed=False), ids(exclude=True)) == ([2], [1, 3], [3])
    assert (ids(search="truck big"), ids(search="truck some")) == ([3], [])
    first = review.queue(df).orderBy("id").first()
    assert (first["short_text"], first["has_correction"]) == ("a b", False)


@pytest.mark.parametrize("after,want", [(0, 1), (1, 3), (3, 1), (99, 1)])
def test_next_unreviewed(spark, after, want):
    df = rows(spark, {}, {"reviewed": DAY}, {}, {"reviewed": DAY})
    assert review.next_unreviewed(df, after).first()[0] == want


def test_queue_empty(spark):
    assert review.next_unreviewed(rows(spark, {"reviewed": DAY}), 0).first()[0] is None


# A seed of the shape the error plan is meant for: one-line rows first, the third
# with a weight, the seventh with two lines.
def seed(spark):
    plain = lambda q: [line(quantity=q, origin="CHI")]
    gold = [plain(1), plain(2), [line(weight=4200, pickup_month=4, pickup_day=5)], plain(4), plain(5), plain(6),
            [line(quantity=15, reference="B-1"), line(quantity=16, leg="delivery", reference="B-1")], plain(8)]
    data = [(i, f"row-{i}", f"text {i} B-1", g) for i, g in enumerate(gold)]
    return spark.createDataFrame(data, f"row_idx int, id string, text string, gold {LINES.simpleString()}")


def test_plan_and_categories(spark):
    df = seed(spark)
    plan = LE.plan_first_suitable(df)
    assert plan == {6: "ordering", 2: "missing", 0: "hallucination", 1: "mapping"}
    bad = LE.with_plan(df, plan).select("*", LE.corrupt("kind", "gold").alias("bad"))
    out = score(bad.select("row_idx", F.col("gold").alias("expected"), F.col("bad").alias("predicted")))
    got = {r["row_idx"]: r["category"] for r in out.collect()}
    assert {k: got[k] for k in plan} == {6: "UNORDERED", 2: "BAD_WEIGHT", 0: "BAD_REFERENCE", 1: "BAD_QUANTITY"}
    assert all(got[k] == "CORRECT" for k in got if k not in plan)
    assert LE.load_report(LE.with_plan(df, plan)).count() == 5
    assert LE.injected_errors(LE.with_plan(df, plan)).count() == 4


def test_no_row_is_claimed_twice(spark):
    df = seed(spark).where("row_idx = 6")
    assert LE.plan_first_suitable(df) == {6: "ordering"}
    assert LE.plan_first_suitable(seed(spark).where("row_idx < 2")) == {0: "hallucination", 1: "mapping"}


def test_missing_takes_the_first_line_that_has_a_value(spark):
    gold = [line(), line(pickup_month=2, pickup_day=3, pickup_year=2025), line(weight=1)]
    df = spark.createDataFrame([("missing", gold)], f"kind string, gold {LINES.simpleString()}")
    got = df.select(LE.corrupt("kind", "gold").alias("v")).first()["v"]
    assert [tuple(x) for x in got] == [line(), line(pickup_month=2, pickup_day=3), line(weight=1)]


def test_review_rows(spark):
    planned = LE.with_plan(seed(spark), {6: "ordering"})
    now = F.lit(DAY)
    fresh = LE.review_rows(planned, auto_review=False, now=now)
    assert fresh.columns == REVIEWS.fieldNames()
    assert fresh.where("reviewed is not null or corrected is not null").count() == 0
    done = LE.review_rows(planned, auto_review=True, now=now)
    assert done.where("reviewed is null").count() == 0
    fixed = done.where("corrected is not null").collect()
    gold = seed(spark).where("row_idx = 6").select(lines_json("gold")).first()[0]
    assert [(r["id"], r["corrected"]) for r in fixed] == [(7, gold)]
    assert fixed[0]["parsed"] != gold


def test_fraction_mode(spark):
    base = seed(spark)
    copies = F.explode(F.sequence(F.lit(1), F.lit(400))).alias("k")
    many = base.where("row_idx in (0, 2, 6)").select("id", "text", "gold", copies)
    many = many.withColumn("row_idx", F.xxhash64("k", "id"))
    hit = LE.with_fraction(many, 250, seed=1)
    n = hit.where("kind is not null").count()
    assert 200 < n < 400
    assert hit.where("kind = 'ordering' and size(gold) < 2").count() == 0
    assert LE.with_fraction(many, 0, seed=1).where("kind is not null").count() == 0


def test_audit_classes(spark):
    gold = [line(**FULL), line(quantity=2, leg="delivery")]

    def first(**kw):
        return [line(**{**FULL, **kw}), gold[1]]

    cases = [
        (gold, None), (gold[::-1], "wrong-order"), (first(accessorial=5), "hallucinated"),
        (first(weight=None), "missing"), (first(quantity=13), "wrong-mapping"),
        (gold + gold, "hallucinated"), (gold[:1], "missing"), (None, "INVALID"),
    ]
    ddl = f"id int, proposed {LINES.simpleString()}, gold {LINES.simpleString()}, text string"
    df = spark.createDataFrame([(i, c, gold, "PO-1") for i, (c, _) in enumerate(cases)], ddl)
    got = [r["error_class"] for r in LE.audit(df).orderBy("id").collect()]
    assert got == [c for _, c in cases]
