import json

import pytest
from conftest import line
from pyspark.sql import functions as F

from ladewerk.operators import gate
from ladewerk.operators.extract import extract, extract_with, parse, predictions
from ladewerk.operators.generate import generate
from ladewerk.operators.registry import registry_table, resolve_models
from ladewerk.operators.scoring import score

WRITTEN = [
    (
        "Harbor desk: PU 9 pallets Tulsa -> BOI, rate 1,310.25",
        [line(quantity=9, rate="1310.25", origin="Tulsa", destination="BOI")],
    ),
    (
        "Morning! delivery 31 cartons from Omaha to Salt Lake. Rate 640.00",
        [line(quantity=31, unit="cartons", leg="delivery", rate=640, origin="Omaha", destination="Salt Lake")],
    ),
    (
        "pu Oct 22nd, 17 skids OMA to BOI, weight 3,050 lb, rate 905.10",
        [line(quantity=17, unit="skids", rate="905.1", origin="OMA", destination="BOI", weight=3050,
              pickup_day=22, pickup_month=10)],
    ),
    (
        "Leaving in NOV, 2 containers Reno -> Fresno, rate 4,000.00",
        [line(quantity=2, unit="containers", rate=4000, origin="Reno", destination="Fresno", pickup_month=11)],
    ),
    (
        "PU 7/30/25 - 6 pallets RNO to Fresno @ rate 777.00",
        [line(quantity=6, rate=777, origin="RNO", destination="Fresno", pickup_day=30, pickup_month=7,
              pickup_year=2025)],
    ),
    (
        "SO#80412 - pickup 3 skids @615lbs ea, TUL to Omaha, rate 1.95/mi",
        [line(quantity=3, unit="skids", rate="1.95", origin="TUL", destination="Omaha", weight=615,
              reference="SO#80412")],
    ),
    (
        "Two stops - PRO-9031\nStop 1: PU 8 cartons TUL -> OMA, rate 510.00\n"
        "Stop 2: DLV 8 cartons OMA -> Salt Lake, rate 620.00, detention 80.50",
        [line(quantity=8, unit="cartons", rate=510, origin="TUL", destination="OMA", reference="PRO-9031"),
         line(quantity=8, unit="cartons", rate=620, leg="delivery", origin="OMA", destination="Salt Lake",
              accessorial="80.5", reference="PRO-9031")],
    ),
    (
        "PU 4 pallets BOI to TUL rate 900.00 and PU 6 skids OMA to RNO rate 800.00",
        [line(quantity=4, rate=900, origin="BOI", destination="TUL"),
         line(quantity=6, unit="skids", rate=800, origin="OMA", destination="RNO")],
    ),
    (
        "Desk 3: PU 4 pallets BOI to TUL rate 900.00; DLV 6 skids rate 800.00, 2 cartons rate 70.00 PO-77",
        [line(quantity=4, rate=900, origin="BOI", destination="TUL", reference="PO-77"),
         line(quantity=6, unit="skids", rate=800, leg="delivery", reference="PO-77"),
         line(quantity=2, unit="cartons", rate=70, reference="PO-77")],
    ),
    (  # a second count of one shipment is no shipment of its own
        "PU 4 pallets, 90 cartons BOI to TUL rate 900.00",
        [line(quantity=4, rate=900, origin="BOI", destination="TUL")],
    ),
    (
        "Depot note acct#KX-7731\nPU 5 skids BOI -> TUL rate 410.00\nDLV 5 skids TUL -> OMA rate 620.00",
        [line(quantity=5, unit="skids", rate=410, origin="BOI", destination="TUL", reference="acct#KX-7731"),
         line(quantity=5, unit="skids", leg="delivery", rate=620, origin="TUL", destination="OMA", reference="acct#KX-7731")],
    ),
    (
        "FSC 45.50 on all legs\nPU 5 skids rate 410.00\nDLV 5 skids rate 620.00, detention 80.00",
        [line(quantity=5, unit="skids", rate=410, accessorial="45.5"),
         line(quantity=5, unit="skids", leg="delivery", rate=620, accessorial=80)],
    ),
    (
        "Leg 1: PU 5 skids rate 410.00\nLeg 2: DLV 5 skids rate 620.00\nLumper 33.00 on leg 2.",
        [line(quantity=5, unit="skids", rate=410), line(quantity=5, unit="skids", leg="delivery", rate=620, accessorial=33)],
    ),
    (
        "Pick up 6 pallets at the Omaha yard bound for Tulsa, rate 505.00",
        [line(quantity=6, rate=505, origin="Omaha", destination="Tulsa")],
    ),
    (
        "Deliver 6 pallets into Tulsa from Omaha. Detention billed at 70.00/hr. Rate 505.00",
        [line(quantity=6, leg="delivery", rate=505, origin="Omaha", destination="Tulsa", accessorial=70)],
    ),
]


def test_messages_written_by_hand(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WRITTEN)], "id int, text string")
    got = extract(df).orderBy("id").collect()
    assert [[tuple(x) for x in r["items"] or []] for r in got] == [want for _, want in WRITTEN]


def test_reading_back_what_was_written(spark):
    made = generate(spark, 1500, seed=21).select("id", "text", F.col("lines").alias("expected"))
    runs = predictions(extract(made, "full"), "full", "v1").unionByName(
        predictions(extract(made, "clean"), "clean", "v1")
    )
    ranked = gate.comparison_table(score(runs)).collect()
    assert [r["model_name"] for r in ranked] == ["full", "clean"]
    assert ranked[0]["pct_correct"] == 100.0
    assert 20 < ranked[1]["pct_correct"] < 90


def test_text_without_lines_and_without_a_rate(spark):
    df = spark.createDataFrame([(1, "hello"), (2, "PU 5 skids CHI to LAX"), (3, None)], "id int, text string")
    got = extract(df).orderBy("id").collect()
    assert (got[0]["items"], got[0]["error"]) == ([], None)
    assert (got[1]["items"], got[1]["error"]) == (None, "ValueError: a line lacks a required field")
    assert got[2]["items"] is None and got[2]["error"]


def test_external_model(spark):
    def model(prompts):
        out = []
        for p in prompts:
            if "bad" in p:
                raise RuntimeError("no answer")
            if "junk" in p:
                out.append('{"items": [{"quantity": "x"}]}')
                continue
            assert p.endswith("\n") and "Confirmation:\n" in p
            item = {"quantity": 2, "unit": "pallets", "leg": "pickup", "rate": 1847.50, "reference": "PO-9"}
            out.append(json.dumps({"items": [item] * (3 if "Hint: three" in p else 1)}))
        return out

    rows = [(1, "about PO-9", None), (2, "nothing", "three"), (3, "bad", None), (4, "junk", None)]
    df = spark.createDataFrame(rows, "id int, text string, hint string")
    got = {r["id"]: r for r in extract_with(df, model, guidance="hint").collect()}
    assert (got[1]["items"][0]["reference"], got[1]["reference_guarded"]) == ("PO-9", False)
    assert got[1]["duration"] is not None
    assert (len(got[2]["items"]), got[2]["items"][0]["reference"], got[2]["reference_guarded"]) == (3, None, True)
    assert (got[3]["items"], got[3]["error"], got[3]["duration"]) == (None, "RuntimeError: no answer", None)
    assert got[4]["items"] is None and got[4]["error"].startswith("ValueError")


def test_predictions_are_credited_to_the_request(spark):
    df = spark.createDataFrame([(1, "hello", "newer", True), (2, "PU 5 skids", "newer", True)],
                               "id int, text string, effective_model string, fell_back boolean")
    raw = predictions(extract(df.withColumn("expected", F.array())), "lightweight", "v2").orderBy("id").collect()
    assert [r["model_name"] for r in raw] == ["lightweight"] * 2
    assert (raw[0]["effective_model"], raw[0]["fell_back"]) == ("newer", True)
    assert (raw[1]["effective_model"], raw[1]["fell_back"]) == (None, None)


ENTRIES = [
    {"name": "older", "base": "b1", "has_adapter": True}, {"name": "newer", "base": "b2", "has_adapter": True},
    {"name": "light", "base": "b3", "label": "Light"},
]


@pytest.mark.parametrize("default_ready", [True, False])
def test_model_resolution(spark, default_ready):
    entries = [dict(e, has_adapter=default_ready) if e["name"] == "newer" else e for e in ENTRIES]
    asked = spark.createDataFrame([(m,) for m in ("older", "newer", "light", "ghost", "", None)], "model string")
    rows = resolve_models(asked, registry_table(spark, entries, env={})).collect()
    got = [(r["effective_model"], r["fell_back"]) for r in rows]
    light = ("newer", True) if default_ready else ("light", False)
    assert got == [("older", False), ("newer", False), light, ("newer", True), ("newer", False), ("newer", False)]
    assert [r["requested_model"] for r in rows][-2:] == ["newer", "newer"]


def test_registry_table(spark):
    rows = registry_table(spark, ENTRIES, env={"MODEL_BASE_LIGHT": "mirror"}).collect()
    assert [r["name"] for r in rows] == ["older", "newer", "light"]
    assert (rows[2]["base"], rows[2]["label"], rows[0]["label"]) == ("mirror", "Light", "older")
    assert [r["is_default"] for r in rows] == [False, True, False]


def test_parse_uses_the_rules_of_the_answering_model(spark):
    asked = spark.createDataFrame(
        [(1, "older"), (2, "light"), (3, None)], "id int, model string"
    ).withColumn("text", F.lit("PU 4 plts CHI to LAX $10.00"))
    out = parse(asked, registry_table(spark, ENTRIES, env={}), {"older": "clean", "newer": "full"})
    got = {r["id"]: (r["effective_model"], r["fell_back"], len(r["items"])) for r in out.collect()}
    assert got == {1: ("older", False, 0), 2: ("newer", True, 1), 3: ("newer", False, 1)}
