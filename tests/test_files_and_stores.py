import json
import random

import pytest
from pyspark.sql import functions as F

from ladewerk.functions.validation import parse_lines
from ladewerk.operators.generate import generate
from ladewerk.operators import scoring
from ladewerk.operators.extract import extract_with, predictions
from ladewerk.plans import jobs
from ladewerk.schema import GATE_COLUMNS, LABELLED, LINES, PREDICTIONS
from ladewerk.sources import files, positions, search, stores, versions

LINE = '{"quantity": 1, "unit": "skids", "leg": "pickup", "rate": 2.5}'
GOOD = '{"id": "1", "text": "t", "parsed_json": "[]"}'


def test_reading_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text(f"{GOOD}\n\n   \n{GOOD}\n")
    assert files.read_jsonl(spark, str(path), LABELLED).count() == 2
    gone = str(tmp_path / "gone.jsonl")
    assert files.read_jsonl(spark, gone, LABELLED, missing_ok=True).count() == 0
    with pytest.raises(Exception):
        files.read_jsonl(spark, gone, LABELLED).count()


def test_broken_lines(spark, tmp_path):
    path = tmp_path / "b.jsonl"
    path.write_text(f"\n{GOOD}\n{{oops\n")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(path), LABELLED).collect()
    rows = files.broken_lines(spark, str(path), LABELLED).collect()
    assert [(r["line_no"], r["line"]) for r in rows] == [(3, "{oops")]
    assert rows[0]["file"].endswith("b.jsonl")


def numbers(spark, path, **options):
    rows = positions.numbered_lines(spark, str(path), **options).collect()
    return sorted((r["row_idx"], r["file"].rsplit("/", 1)[1], r["line_no"], r["line"]) for r in rows)


def plain_numbers(folder):
    out = []
    for p in sorted(folder.iterdir()):
        lines = p.read_bytes().decode().split("\n")
        for no, line in enumerate(lines[:-1] if not lines[-1] else lines, 1):
            line = line.removesuffix("\r")
            if line.strip():
                out.append((len(out), p.name, no, line))
    return out


@pytest.mark.parametrize("split", ["1k", "100", "128m"])
def test_lines_are_numbered_across_splits(spark, tmp_path, split):
    r = random.Random(3)
    for name in "ba-c":
        lines = [r.choice(["", "  ", "\t"]) if r.random() < 0.3 else f"{name}{i} é" + "x" * r.randrange(90) for i in range(400)]
        (tmp_path / f"{name}.txt").write_bytes(("\r\n" if name == "-" else "\n").join(lines).encode() + b"\n" * (name == "a"))
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "blank.txt").write_text("\n\n \n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert numbers(spark, tmp_path) == plain_numbers(tmp_path)
        assert numbers(spark, tmp_path, broadcast_splits=0) == plain_numbers(tmp_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_changed_splits_are_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{i}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    numbered = positions.numbered_lines(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        with pytest.raises(Exception, match="splits of a file changed"):
            # A plan of its own: the other one was settled when it was first shown.
            numbered.select("row_idx").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_seed(spark, tmp_path):
    path = tmp_path / "s.jsonl"
    path.write_text("\n")
    with pytest.raises(ValueError, match="empty"):
        files.read_seed(spark, str(path), str(tmp_path / "k0"))
    path.write_text('\n{"id": "s", "text": "t", "gold": [{"quantity": 1, "unit": "u", "leg": "l", "rate": 2.16}]}\n')
    row = files.read_seed(spark, str(path), str(tmp_path / "k1")).first()
    assert (row["row_idx"], row["id"], str(row["gold"][0]["rate"])[:4]) == (0, "s", "2.16")


def test_seed_errors_name_file_and_line(spark, tmp_path):
    good = '{"id": "s", "text": "t", "gold": []}'
    path = tmp_path / "s.jsonl"
    path.write_text("\n".join([good, "", "[1]", '{"text": "t", "gold": [{}]}', '{"id": "x", "gold": []}', good + " more", "{oops"]))
    problems = files.seed_problems(files.checked_seed(spark, str(path))).orderBy("line_no").collect()
    assert [(r["place"].rsplit("/", 1)[1], r["problem"]) for r in problems] == [
        ("s.jsonl:3", "not an object"), ("s.jsonl:4", "no sound gold lines"), ("s.jsonl:5", "no text"),
        ("s.jsonl:6", "invalid JSON"), ("s.jsonl:7", "invalid JSON"),
    ]
    store = stores.ReviewStore(spark, str(tmp_path / "queue"))
    with pytest.raises(ValueError, match=r"s\.jsonl:3: not an object \(and 4 more lines\)"):
        jobs.load_reviews(spark, str(path), store, str(tmp_path / "w"), now=F.lit("2026-01-01").cast("timestamp"))
    assert store.read().count() == 0


def test_reviews_are_loaded_from_a_seed_file(spark, tmp_path):
    two = '{"quantity": 1, "unit": "skids", "leg": "pickup", "rate": 2.5}, {"quantity": 2, "unit": "skids", "leg": "delivery", "rate": 3}'
    golds = [LINE, LINE[:-1] + ', "weight": 900}', "", two, LINE]
    path = tmp_path / "s.jsonl"
    path.write_text("\n \n".join(f'{{"id": "seed-{i}", "text": "t{i}", "gold": [{g}]}}' for i, g in enumerate(golds)))
    store = stores.ReviewStore(spark, str(tmp_path / "queue"))
    now = F.lit("2026-01-01").cast("timestamp")
    for turn in range(2):  # loading again replaces the queue
        shown = jobs.load_reviews(spark, str(path), store, str(tmp_path / f"w{turn}"), now=now, auto_review=True)
        assert {(r["row_idx"], r["id"], r["kind"]) for r in shown.collect()} == {
            (3, "seed-3", "ordering"), (1, "seed-1", "missing"), (0, "seed-0", "hallucination"), (4, "seed-4", "mapping"),
        }
        rows = {r["id"]: r for r in store.read().collect()}
        assert [rows[i]["text"] for i in range(1, 6)] == [f"t{i}" for i in range(5)]
        assert rows[3]["corrected"] is None and json.loads(rows[2]["corrected"])[0]["weight"] == 900
        assert "weight" not in json.loads(rows[2]["parsed"])[0] and json.loads(rows[5]["parsed"])[0]["quantity"] == 8


def test_guard_checks_all_before_writing(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    files.guard_outputs(spark, [a, b])
    assert files.write_jsonl(spark.range(3), b) == 3
    with pytest.raises(FileExistsError):
        files.guard_outputs(spark, [a, b])
    files.guard_outputs(spark, [a, b], force=True)
    files.guard_outputs(spark, [a])


def test_gate_files_are_not_read_recursively(spark, tmp_path):
    row = {"model_name": "m", "version": "v", "category": "CORRECT", "duration": 1.0, "field_accuracy": 1.0,
           "expected": [{"x": 1}]}
    (tmp_path / "promoted").mkdir()
    for place in (tmp_path / "m.jsonl", tmp_path / "promoted" / "current.jsonl"):
        place.write_text(json.dumps(row) + "\n")
    rows = files.read_gate_files(spark, str(tmp_path / "*.jsonl"), GATE_COLUMNS).collect()
    assert [(r["model_name"], r["file_model"]) for r in rows] == [("m", "m")]


def test_example_store(spark, tmp_path):
    store = stores.ExampleStore(spark, str(tmp_path / "examples"))
    made = generate(spark, 25, seed=3)
    assert store.replace(made) == 25
    assert store.replace(made) == store.count() == 25
    assert [r["id"] for r in store.sample(3).collect()] == [f"synth-3-{i:05d}" for i in range(3)]
    out = tmp_path / "jsonl"
    assert store.export_jsonl(str(out)) == 25
    lines = [json.loads(x) for p in sorted(out.glob("part-*")) for x in p.read_text().splitlines()]
    assert [x["id"] for x in lines] == [f"synth-3-{i:05d}" for i in range(25)]
    assert set(lines[0]) == {"id", "text", "parsed_json", "style"}
    assert isinstance(lines[0]["parsed_json"], str)
    store.reset()
    assert store.count() == 0


def scored(spark, model, categories):
    rows = [(f"{i}", c) for i, c in enumerate(categories)]
    df = spark.createDataFrame(rows, "id string, category string")
    values = {"model_name": F.lit(model), "version": F.lit("v1"), "id": F.col("id"), "category": F.col("category")}
    return df.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PREDICTIONS.fields]
    )


def test_prediction_store(spark, tmp_path):
    store = stores.PredictionStore(spark, str(tmp_path / "p"))
    store.write(scored(spark, "a", ["CORRECT", "ERROR"]))
    store.write(scored(spark, "b", ["CORRECT"]))
    store.write(scored(spark, "a", ["ERROR"]))
    assert sorted((r["model_name"], r["category"]) for r in store.scored().collect()) == [
        ("a", "ERROR"), ("b", "CORRECT")
    ]
    assert store.raw().count() == 2
    assert "category" not in store.raw().columns
    assert store.incumbent() is None
    store.promote(store.scored().where("model_name = 'b'"))
    store.promote(store.scored().where("model_name = 'a'"))
    assert [r["model_name"] for r in store.incumbent().collect()] == ["a"]
    # A snapshot is never counted with the runs.
    assert store.scored().count() == 2
    # One that was not finished is never the incumbent.
    (tmp_path / "p" / "promoted" / "000002").mkdir()
    assert [r["model_name"] for r in store.incumbent().collect()] == ["a"]
    assert store.promote(store.scored().where("model_name = 'b'")).endswith("000003")
    assert [r["model_name"] for r in store.incumbent().collect()] == ["b"]


def test_latest_run_of_each_model_counts(spark, tmp_path):
    store = stores.PredictionStore(spark, str(tmp_path / "p"))
    store.write(scored(spark, "a", ["CORRECT", "ERROR"]).unionByName(scored(spark, "c", ["CORRECT"])))
    run = store.write(scored(spark, "a", ["ERROR"]))
    assert [r["category"] for r in store.scored(run).collect()] == ["ERROR"]
    assert sorted((r["model_name"], r["category"]) for r in store.scored().collect()) == [("a", "ERROR"), ("c", "CORRECT")]
    # A run that ended before it was published counts nowhere.
    (tmp_path / "p" / "scored" / "run=lost").mkdir()
    assert store.scored().count() == store.raw().count() == 2
    store.tidy()
    assert store.scored().count() == 2 and not (tmp_path / "p" / "scored" / "run=lost").exists()


def test_answers_are_evaluated_once(spark, tmp_path):
    def coin(prompts):
        """A model that never answers the same way twice."""
        line = {"unit": "skids", "leg": "pickup", "rate": 1}
        return [json.dumps({"items": [{**line, "quantity": random.SystemRandom().randrange(10**9)}]}) for _ in prompts]

    store = stores.PredictionStore(spark, str(tmp_path / "p"))
    texts = spark.range(40).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("text"), F.array().cast(LINES).alias("expected"))
    run = store.record(predictions(extract_with(texts, coin), "coin", "v1"))
    answers = [{r["id"]: r["predicted"] for r in rows.collect()} for rows in (store.raw(run), store.scored(run), store.raw(), store.scored())]
    assert answers[0] == answers[1] == answers[2] == answers[3] and len(answers[0]) == 40
    # What a lost task computes again is read from the store, not asked of the model.
    assert "mapInArrow" not in store.scored(run)._jdf.queryExecution().toString()


def test_manifests(spark, tmp_path):
    log = versions.ManifestLog(spark, str(tmp_path / "log"))
    assert log.current() is None
    log.publish(lambda now: {"n": now.get("n", 0) + 1})
    log.publish(lambda now: {"n": now.get("n", 0) + 1})
    assert log.current()["n"] == 2
    # One whose writer died half way is passed over, and its number is not used again.
    (tmp_path / "log" / "00000002.json").write_text('{"n": 9')
    assert log.current()["n"] == 2
    # Another writer takes the next number first: the change is made on what it published.
    seen = []

    def change(now):
        if not seen:
            files.create_small(spark, str(tmp_path / "log" / "00000003.json"), '{"n": 50, "complete": true}')
        seen.append(now)
        return {"n": now["n"] + 1}

    assert log.publish(change)["n"] == 51 and [x["n"] for x in seen] == [2, 50]
    assert (tmp_path / "log" / "00000004.json").exists()


def test_gate_over_files(spark, tmp_path):
    rows = scored(spark, "a b", ["CORRECT", "ERROR", None, "?"]).unionByName(scored(spark, "c", ["CORRECT"]))
    files.write_gate_files(rows.select(*GATE_COLUMNS.fieldNames(), "id"), str(tmp_path / "g"))
    (tmp_path / "g" / "promoted").mkdir()
    (tmp_path / "g" / "promoted" / "x.jsonl").write_text('{"model_name": "x"}')
    breakdown, ranking = jobs.gate_files(spark, str(tmp_path / "g" / "*.jsonl"))
    assert [(r["model_name"].replace("%20", " "), r["category"], r["n"]) for r in breakdown.collect()] == [
        ("a b", "ERROR", 1), ("a b", "CORRECT", 1), ("a b", "OTHER", 1), ("c", "CORRECT", 1)
    ]
    assert [(r["model_name"], r["n"]) for r in ranking.collect()] == [("c", 1), ("a b", 4)]


def test_review_store(spark, tmp_path):
    store = stores.ReviewStore(spark, str(tmp_path / "r"))
    one = spark.sql(
        "select 1L id, 't' text, '[]' parsed, null corrected, null reviewed, false exclude, "
        "timestamp'2026-01-01' created"
    )
    assert store.read().count() == 0
    assert store.reload(one) == store.reload(one) == store.read().count() == 1
    # The queue may be made from itself.
    assert store.reload(store.read().withColumn("exclude", F.lit(True))) == 1
    assert store.read().first()["exclude"]
    store.tidy()
    assert store.read().count() == 1 and len(list((tmp_path / "r" / "data").iterdir())) == 1


def test_dataset_folder(spark, tmp_path):
    data = stores.DatasetFolder(spark, str(tmp_path / "d"))
    assert data.fixed_benchmark() is None
    train = spark.createDataFrame([("i", 'say "x"\né', "[]")], "instruction string, input string, output string")
    bench = spark.createDataFrame([("b1", 'text "q"\né', "[" + LINE + "]")], LABELLED)
    bench = bench.select("id", "text", parse_lines("parsed_json").alias("expected"))
    data.write(train, bench)
    stored = "".join(p.read_text() for p in (tmp_path / "d" / "benchmark").glob("part-*"))
    assert json.loads(stored) == {"id": "b1", "text": 'text "q"\né', "expected": [json.loads(LINE)]}
    assert '"rate": 2.5}' in stored
    assert data.benchmark().collect() == bench.collect()
    assert data.train().collect() == train.collect()
    with pytest.raises(FileExistsError):
        data.write(train, bench)
    with pytest.raises(FileExistsError):
        data.write(train, None)
    data.write(data.train().unionAll(data.train()), data.benchmark(), force=True)
    assert (data.train().count(), data.benchmark().collect()) == (2, bench.collect())
    data.write(train.limit(0), None, force=True)
    assert (data.train().count(), data.fixed_benchmark().count()) == (0, 1)


def test_search_opens_only_files_that_can_match(spark, tmp_path):
    rows = [(i, f"common words Harbor{i // 100} text {i} é" + (" Zweig-42x" if i == 555 else "")) for i in range(1000)] + [(1000, None), (1001, ""), (1002, "ab")]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    store = search.SearchStore(spark, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError):
        store.search("x")
    store.replace(df, rows_per_file=100)
    assert len(store.files_of("common")) >= 10 and len(store.files_of("ZWEIG-42")) == 1 and store.files_of("nowhere") == []
    for query in ("zweig-42X", "harbor7 TEXT", "é", "ab", "nowhere", "common zweig", "words 99", ""):
        got = sorted(r["id"] for r in store.search(query).collect())
        words = query.lower().split()
        assert got == [i for i, t in rows if (t is not None or not words) and all(w in t.lower() for w in words)]
    # The plan of a rare word reads its one file.
    assert len(store.search("zweig-42x").inputFiles()) == 1 and len(store.read().inputFiles()) >= 10
    store.replace(df.limit(3))
    store.tidy()
    assert store.read().count() == 3 and len(list((tmp_path / "s" / "index").iterdir())) == 1


def test_bucketed_gold_is_joined_without_a_shuffle(spark, tmp_path):
    gold = spark.range(50).select(F.col("id").cast("string").alias("id"), F.array().cast(LINES).alias("expected"))
    predicted = gold.select("id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("model_name"), F.col("expected").alias("predicted"))
    kept = []
    for name, rows in (("gold_t", gold), ("predicted_t", predicted)):
        store = stores.BucketedStore(spark, name, str(tmp_path / name), buckets=4)
        store.replace(rows)
        # Another session would have to be told of the table.
        spark.sql(f"DROP TABLE {name}")
        kept.append(store.read(rows.schema))
    try:
        out = scoring.score(scoring.attach_bucketed(kept[1], kept[0]))
        assert out.where("category = 'CORRECT'").count() == 100
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("gold_t", "predicted_t"):
            spark.sql(f"DROP TABLE {name}")


def test_gate_files_are_compressed(spark, tmp_path):
    rows = spark.range(4000).select(
        F.lit("m").alias("model_name"), F.lit("v1").alias("version"), F.lit("CORRECT").alias("category"),
        F.lit(1.0).alias("duration"), F.lit(1.0).alias("field_accuracy"), F.col("id").cast("string").alias("id"),
    )
    files.write_gate_files(rows, str(tmp_path / "g"))
    parts = list((tmp_path / "g" / "m.jsonl").glob("part-*"))
    assert parts and all(p.name.endswith(".gz") for p in parts)
    assert sum(p.stat().st_size for p in parts) < 4000 * 20
    read = files.read_gate_files(spark, str(tmp_path / "g" / "*.jsonl"), GATE_COLUMNS)
    assert [tuple(r) for r in read.groupBy("file_model").count().collect()] == [("m", 4000)]


def test_buckets_grow_with_the_rows():
    assert [stores.buckets_for(n) for n in (0, 150_000, 2_000_001, 9_000_000)] == [8, 8, 9, 36]
