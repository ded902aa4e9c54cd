import pytest
from conftest import line
from pyspark.sql import functions as F

from ladewerk.functions import validation as V
from ladewerk.functions.json_text import lines_json
from ladewerk.functions.validation import (
    date_ladder_ok, guard_references, in_vocabulary, is_valid_lines, one_reference, parse_lines,
    reference_unsupported, review_row_valid,
)
from ladewerk.schema import LINES

GOOD = '"quantity": 1, "unit": "skids", "leg": "pickup", "rate": 10'


def with_field(text):
    name = text.split(":")[0].strip()
    kept = [p for p in GOOD.split(", ") if not p.startswith(name)]
    return "[{" + ", ".join([*kept, text]) + "}]"


CASES = [
    ("[]", True),
    ("[{" + GOOD + "}]", True),
    ("[{" + GOOD + ', "note": {"deep": [1]}}]', True),
    ("{" + GOOD + "}", False),
    ('{"not": "a list"}', False),
    ("null", False), ("[null]", False), ("[1]", False), ("not json", False), ("", False),
    ('[{"unit": "skids", "leg": "pickup"}]', False),
    ("[{" + GOOD + "}, {}]", False),
    (with_field('"quantity": 12.0'), True),
    (with_field('"quantity": "12"'), True),
    (with_field('"quantity": " 12 "'), True),
    (with_field('"quantity": "12.0"'), True),
    (with_field('"quantity": true'), True),
    (with_field('"quantity": 1e2'), True),
    (with_field('"quantity": 12.5'), False),
    (with_field('"quantity": "1e2"'), False),
    (with_field('"quantity": "twelve"'), False),
    (with_field('"quantity": null'), False),
    (with_field('"quantity": [1]'), False),
    (with_field('"rate": "2.50"'), True),
    (with_field('"rate": "1e3"'), True),
    (with_field('"rate": "1,847.50"'), False),
    (with_field('"rate": "NaN"'), False),
    (with_field('"rate": true'), False),
    (with_field('"rate": null'), False),
    (with_field('"unit": 7'), False),
    (with_field('"unit": "anything"'), True),
    (with_field('"leg": null'), False),
    (with_field('"origin": null'), True),
    (with_field('"origin": 5'), False),
    (with_field('"weight": null'), True),
    (with_field('"weight": "heavy"'), False),
    (with_field('"pickup_day": 5.0'), True),
    (with_field('"pickup_day": "5th"'), False),
]


def test_label_rules(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "i int, j string")
    got = {r["i"]: r["ok"] for r in df.select("i", is_valid_lines("j").alias("ok")).collect()}
    wrong = [(c, want) for i, (c, want) in enumerate(CASES) if got[i] != want]
    assert wrong == []


def test_read_values(spark):
    text = with_field('"quantity": "12"').replace('"rate": 10', '"rate": "2.50"')
    row = spark.createDataFrame([(text,)], "j string").select(parse_lines("j").alias("v")).first()
    assert (row["v"][0]["quantity"], str(row["v"][0]["rate"]).rstrip("0")) == (12, "2.5")


def test_null_text_is_invalid_but_not_null(spark):
    df = spark.createDataFrame([(None,)], "j string")
    assert df.select(is_valid_lines("j")).first()[0] is False


@pytest.mark.parametrize(
    "parsed,corrected,ok",
    [
        ("[]", None, True), ("[{" + GOOD + "}]", "[{" + GOOD + "}]", True),
        ("[{" + GOOD + "}]", '{"not": "a list"}', False), ('{"x": 1}', "[]", False),
        ("[]", "null", False),
    ],
)
def test_save_time_rule(spark, parsed, corrected, ok):
    df = spark.createDataFrame([(parsed, corrected)], "p string, c string")
    assert df.select(review_row_valid("p", "c")).first()[0] is ok


def lines_df(spark, lines, text=""):
    return spark.createDataFrame([(lines, text)], f"l {LINES.simpleString()}, t string")


def test_guard(spark):
    df = lines_df(
        spark, [line(reference="PO-999"), line(reference="PO-123"), line(), line(reference="")],
        "order PO-123 confirmed",
    )
    got = df.select(guard_references("l", F.col("t")).alias("g"),
                    reference_unsupported(F.col("l"), F.col("t")).alias("fired")).first()
    assert [x["reference"] for x in got["g"]] == [None, "PO-123", None, ""]
    assert got["fired"] is True
    clean = lines_df(spark, [line(reference="PO-1"), line()], "PO-1")
    assert clean.select(reference_unsupported(F.col("l"), F.col("t"))).first()[0] is False


def test_label_predicates(spark):
    c = F.col("l")
    ok = lines_df(spark, [line(pickup_month=3), line()])
    assert ok.select(date_ladder_ok(c), one_reference(c), in_vocabulary(c)).first() == (True,) * 3
    bad = lines_df(spark, [line(pickup_day=3, reference="a", unit="box"), line(reference="b")])
    assert bad.select(date_ladder_ok(c), one_reference(c), in_vocabulary(c)).first() == (False,) * 3


def test_plain_lists_are_read_in_one_pass_with_the_same_values(spark):
    full = (
        '{"origin": "CHI", "destination": "", "quantity": -12, "unit": "skids", "weight": 4200.25, "pickup_day": 5, "pickup_month": 12, '
        '"pickup_year": 2025, "leg": "pickup", "accessorial": 0.000000000000000001, "rate": 123456789012345678.123456789012345678, "reference": "PO #1, {[\'"}'
    )
    least = "{" + GOOD + "}"
    plain = [f"[{least}]", f"[{full}]", f"[{full}, {least}, {full}]", "[]", "[" + ", ".join([least] * 5_000) + "]"]
    other = [
        f"[{least},{least}]", f"[{least}] ", f"[{least}, ]", f"[{least}]]", f"[{least}", f"[{least}, {{}}]", f"[, {least}]",
        full, f"[{full[:-1]}, \"unit\": \"x\"}}]", "[{" + GOOD.replace("1,", "01,") + "}]", "[{" + GOOD.replace("1,", "1.0,") + "}]",
        "[{" + GOOD.replace("10", "1e2") + "}]", "[{" + GOOD.replace("10", "1.") + "}]", "[{" + GOOD.replace("skids", 'a\\"b') + "}]",
        "[{" + GOOD.replace("skids", "a\nb") + "}]", "[{" + GOOD.replace("skids", "é") + "}]", "[{" + GOOD.replace("1,", "9223372036854775808,") + "}]",
        "[{" + GOOD.replace("10", "1234567890123456789012") + "}]", "[{" + GOOD.replace("10", "0.1234567890123456789") + "}]",
        '[{"destination": "x", "origin": "y", ' + GOOD + "}]", "[{" + GOOD.replace('"leg"', '"pickup_day": 12345678901, "leg"') + "}]", None, "", "\n[]",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(plain + other)], "i int, t string").repartition(3)
    t = F.col("t")
    got = df.select("i", t.rlike(V._PLAIN_LIST).alias("plain"), parse_lines("t").alias("now"), V.lines_of_variant(V.whole_value(t)).alias("checked")).orderBy("i").collect()
    assert [bool(r["plain"]) for r in got] == [True] * len(plain) + [False] * len(other)
    assert [r["now"] for r in got] == [r["checked"] for r in got]
    assert got[1]["now"][0]["reference"] == "PO #1, {['" and got[0]["now"][0]["rate"] == 10 and len(got[4]["now"]) == 5_000


def test_canonical_texts_are_left_as_they_are_and_others_written_anew(spark):
    one = '{"quantity": %s, "unit": "skids", "leg": "pickup", "rate": %s%s}'
    amounts = ["0", "-0", "0.0", "-0.0", "0.5", "-0.5", "1.50", "10", "10.0", "010", "-7", "1847.25", "0.000000000000000001", "123456789012345678.25", "1e3", ".5", '"2.50"']
    texts = ["[]", "[ ]", "null", "not json", "[null]", None, "[" + one % (1, 2, "") + "]x", "[" + one % (1, 2, "") + "] "]
    texts += ["[" + one % (1, a, m) + "]" for a in amounts for m in ("", ', "reference": "PO-1.50"', ', "reference": "\\u00e9"', ', "reference": "x, y"', ', "extra": 1')]
    texts += ["[" + one % (q, 3, "") + ", " + one % (2, "4.50", "") + "]" for q in ("-0", "0", "7", "12.0", "1" * 18, "1" * 19, "1" * 20)]
    texts += ["[" + ('{"weight": %s, "quantity": 1, "unit": "u", "pickup_day": %s, "leg": "l", "accessorial": %s, "rate": 1}' % (a, d, a)) + "]" for a in amounts for d in ("5", "-0", "null")]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = rows.select("t", V.canonical_lines("t").alias("short"), lines_json(V.parse_lines("t")).alias("long"), F.col("t").rlike(V._CANONICAL_LIST).alias("kept")).collect()
    assert [r["t"] for r in got if r["short"] != r["long"]] == []
    assert all(r["long"] == r["t"] for r in got if r["kept"]) and sum(bool(r["kept"]) for r in got) > 20
