"""What a job does once, or with few rows at a time, so that its cost grows with its input."""

import json

from conftest import line
from pyspark.sql import functions as F

from ladewerk.functions import reading
from ladewerk.functions.json_text import lines_json, string_text
from ladewerk.operators import generate, scoring
from ladewerk.plans import queries as Q
from ladewerk.schema import LINES
from ladewerk.sources import files, positions, search, stores

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_export_is_sorted_before_its_texts_are_written(spark):
    out = Q.synth_export(spark, FOLDER)
    text = plan(out)
    assert text.count("rangepartitioning") == 1 and text.index("Generate") < text.index("rangepartitioning")
    ids = [r["id"] for r in out.select("id").collect()]
    assert ids == sorted(ids) and len(ids) == spark.read.parquet(f"{FOLDER}/orders.parquet").count()
    assert generate.generate(spark, 3, 7).orderBy("id").first()["id"] == "synth-7-00000"


def test_written_seed_and_labels_keep_their_order(spark):
    seen = []
    for query in (Q.seed_file_load, Q.export_round_trip):
        seen.append([int(r["id"]) for r in query(spark, FOLDER).select("id").collect()])
    assert sorted(seen[0]) == list(range(1, len(seen[0]) + 1)) and len(set(seen[1])) == len(seen[1])


def test_plain_seed_lines_are_read_as_the_others(spark, tmp_path):
    lines = [line(origin="CHI"), line()]
    df = spark.createDataFrame([("a", 'one "two"\n\\three\t/', lines), ("", "é", [])], f"id string, text string, gold {LINES.simpleString()}")
    row = F.concat(F.lit('{"id": '), string_text(F.col("id")), F.lit(', "text": '), string_text(F.col("text")), F.lit(', "gold": '), lines_json("gold"), F.lit("}"))
    plain, other = [r[0] for r in df.select(row).collect()]
    spaced = plain.replace('{"id"', '{ "id"', 1)
    for i, t in enumerate((plain, spaced, other, plain[:-1], "[1]", plain + "}", plain.replace('"text"', '"txt"'))):
        (tmp_path / f"{i}.jsonl").write_text(t + "\n")
    got = files.checked_seed(spark, str(tmp_path)).orderBy("file").collect()
    assert [r["problem"] for r in got] == [None, None, None, "invalid JSON", "not an object", "invalid JSON", "no text"]
    assert got[0][3:] == got[1][3:] and got[0]["text"] == json.loads(plain)["text"] and got[2]["text"] == "é"
    kinds = spark.createDataFrame([(plain,), (spaced,)], "l string").select(F.col("l").rlike(files._PLAIN_SEED)).collect()
    assert [r[0] for r in kinds] == [True, False]


def test_few_lines_are_handed_to_python_at_once(spark, tmp_path):
    (tmp_path / "a").write_text("x\n" * 2_000)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        numbered = positions.numbered_lines(spark, str(tmp_path / "a"))
        assert int(spark.conf.get(key)) <= 512
        assert sorted(r["row_idx"] for r in numbered.select("row_idx").collect()) == list(range(2_000))
    finally:
        spark.conf.set(key, before)


def test_predictions_meet_their_gold_without_texts(spark, monkeypatch):
    seen, attach = [], scoring.attach_gold
    monkeypatch.setattr(scoring, "attach_gold", lambda predicted, gold: seen.append(predicted.columns) or attach(predicted, gold))
    Q.score_attached_gold(spark, FOLDER)
    assert "text" not in seen[0] and "predicted" in seen[0]


def test_words_of_the_search_index_are_counted_by_hash(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Harbor seven"), (2, "ab"), (3, None)], "id int, text string")
    store = search.SearchStore(spark, str(tmp_path / "s"))
    store.replace(rows)
    index = spark.read.parquet(f"{tmp_path}/s/index/*")
    assert {"file", "word", "bits"} <= set(index.columns) and len(store.files_of("harbor")) == 1 and store.files_of("harbour") == []
    places = search.trigram_places(rows, "text", "id")
    assert places.where("id = 1").count() == 10 and places.where("id > 1").count() == 0


def test_rows_of_several_models_are_stored_without_a_sort(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with files.open_together(spark):
        assert int(spark.conf.get(key)) > 3
    assert spark.conf.get(key) == before
    store = stores.PredictionStore(spark, str(tmp_path / "p"))
    store.write(Q._scored(spark, FOLDER))
    assert store.scored().count() == 3 * spark.read.parquet(f"{FOLDER}/orders.parquet").count()


def test_each_reading_rule_searches_once_and_looks_before(spark):
    assert "nullif(" not in reading._found("s", "(b+)")
    found = spark.sql(f"SELECT {reading._found("'abbc'", '(b+)')}, {reading._found("'ac'", '(b+)')}").first()
    assert tuple(found) == ("bb", None)
    rules = reading.FULL
    patterns = [*rules.both_ends, rules.start_only, rules.end_only, rules.delivery, *rules.charge, reading.REFERENCE]
    assert not [p for p in patterns if p.removeprefix("(?i)").startswith(r"\b")]


def test_many_files_of_a_search_are_chosen_from_one_listing(spark, tmp_path, monkeypatch):
    store = search.SearchStore(spark, str(tmp_path / "s"))
    rows = [(i, f"Harbor {'seven' if i < 500 else 'eight'}\nline{i} tail") for i in range(1_000)]
    store.replace(spark.createDataFrame(rows, "id int, text string").coalesce(1), rows_per_file=50)
    by_name = store.search("SEVEN tail")
    assert len(by_name.inputFiles()) == 10
    monkeypatch.setattr(search, "NAMED_FILES", 4)
    chosen = store.search("SEVEN tail")
    assert sorted(r["id"] for r in chosen.collect()) == sorted(r["id"] for r in by_name.collect()) == list(range(500))
    leaf = chosen._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().get("numFiles").get().value() == 10
    # No trigram reaches over a blank or a line's end; the index names files by their paths.
    assert store.files_of("n lin") == store.files_of("lin") and store.files_of("nlin") == []
    parts = search.blank_free(store.read().where("id = 7"), "text", "id")
    assert sorted(r["part"] for r in parts.collect()) == ["harbor", "line7", "seven", "tail"]


def test_candidates_answer_what_the_benchmark_asks(spark, monkeypatch):
    asked, made = [], Q.B.predictions
    monkeypatch.setattr(Q.B, "predictions", lambda confirmed: asked.append(confirmed.count()) or made(confirmed))
    steps = Q.retrain_cycle(spark, FOLDER).collect()
    assert asked == [r["n_benchmark"] for r in steps]
