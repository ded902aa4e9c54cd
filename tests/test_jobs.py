from collections import Counter

import pytest
from pyspark.sql import functions as F

from ladewerk.operators import review
from ladewerk.operators.extract import predictions
from ladewerk.operators.selection import sample_exact, seeded_split
from ladewerk.plans import jobs
from ladewerk.schema import INSTRUCTION, LABELLED
from ladewerk.sources import stores

ONE = '[{"quantity": 1, "unit": "skids", "leg": "pickup", "rate": 2}]'
TWO = ONE[:-1] + ", " + ONE[1:]


def labelled(spark, prefix, n, text=None):
    rows = [(f"{prefix}{i}", text or f"{prefix} text {i}", ONE if i % 2 else TWO) for i in range(n)]
    return spark.createDataFrame(rows, LABELLED)


def texts(df, column):
    return Counter(r[0] for r in df.select(column).collect())


def synthetic(spark, n):
    return labelled(spark, "syn", n).withColumn("style", F.lit("terse"))


def test_ratio_holdout_and_summary(spark):
    p = jobs.prepare_dataset(labelled(spark, "real", 20), synthetic(spark, 200), seed=3)
    assert tuple(p.summary().first()) == (20, 80, 85, 15)
    assert p.train.columns == ["instruction", "input", "output"]
    assert p.benchmark.columns == ["id", "text", "expected"]
    train, bench = texts(p.train, "input"), texts(p.benchmark, "text")
    assert (sum(train.values()), sum(bench.values())) == (85, 15)
    assert not set(train) & set(bench)
    assert sum(t.startswith("real") for t in train + bench) == 20
    assert p.train.select("instruction").distinct().first()[0] == INSTRUCTION
    row = p.benchmark.first()
    assert row["expected"][0]["quantity"] == 1


@pytest.mark.parametrize(
    "n_real,n_syn,options,want",
    [
        (0, 40, {}, (0, 40, 34, 6)), (10, 5, {}, (10, 5, 13, 2)),
        (10, 40, {"holdout_count": 0}, (10, 40, 50, 0)),
        (3, 0, {"holdout_count": 99}, (3, 0, 0, 3)), (1, 0, {}, (1, 0, 0, 1)),
        (10, 100, {"synthetic_ratio": 0.25}, (10, 2, 10, 2)),
        (10, 0, {"max_train": 4}, (10, 0, 4, 2)), (10, 100, {"synthetic_ratio": 0.0}, (10, 0, 8, 2)),
    ],
)
def test_sizes(spark, n_real, n_syn, options, want):
    p = jobs.prepare_dataset(labelled(spark, "real", n_real), synthetic(spark, n_syn), **options)
    assert tuple(p.summary().first()) == want
    assert p.train.count() == want[2]
    assert p.benchmark.count() == want[3]


def test_preparing_takes_two_passes(spark, tmp_path):
    """Five jobs at most before the first row, and the rows that step by step selection gives."""
    labelled(spark, "real", 200).write.parquet(str(tmp_path / "real"))
    synthetic(spark, 3000).write.parquet(str(tmp_path / "syn"))
    real, syn = spark.read.parquet(str(tmp_path / "real")), spark.read.parquet(str(tmp_path / "syn"))
    spark.sparkContext.setJobGroup("prepare", "prepare")
    try:
        p = jobs.prepare_dataset(real, syn, seed=5, max_train=400)
        ran = spark.sparkContext.statusTracker().getJobIdsForGroup("prepare")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(ran) <= 5
    pool = real.withColumn("source", F.lit("real")).unionByName(
        sample_exact(syn, 800, 5).withColumn("source", F.lit("synthetic")), allowMissingColumns=True
    )
    held, rest = seeded_split(pool, 150, 5)
    assert texts(p.benchmark, "text") == texts(held, "text")
    assert texts(p.train, "input") == texts(seeded_split(rest, 400, 5)[0], "text")
    assert p.counts == {"real": 200, "synthetic_used": 800, "train": 400, "benchmark": 150}


def test_shared_ids_and_rows_without_one(spark):
    rows = [("same", f"a{k}", ONE) for k in range(60)] + [(None, f"b{k}", TWO) for k in range(60)] + [(f"id{k}", f"c{k}", ONE) for k in range(30)]
    real = spark.createDataFrame(rows, LABELLED)
    p = jobs.prepare_dataset(real, synthetic(spark, 900), seed=2, holdout_count=70, max_train=300)
    assert (p.train.count(), p.benchmark.count()) == (300, 70)
    assert p.counts == {"real": 150, "synthetic_used": 600, "train": 300, "benchmark": 70}
    assert p.benchmark.where("id IS NULL").count() == 0
    assert not set(texts(p.train, "input")) & set(texts(p.benchmark, "text"))


def test_fixed_benchmark_never_reaches_training(spark):
    real, syn = labelled(spark, "real", 20), synthetic(spark, 80)
    first = jobs.prepare_dataset(real, syn, seed=3)
    copies = first.benchmark.select(F.concat(F.lit("copy-"), "id").alias("id"), "text", F.lit(ONE).alias("parsed_json"))
    again = jobs.prepare_dataset(
        real.unionByName(copies), syn, seed=3, fixed_benchmark=first.benchmark, reuse_benchmark=True
    )
    assert again.benchmark is None and again.counts["benchmark"] == 0
    assert not set(texts(again.train, "input")) & set(texts(first.benchmark, "text"))
    assert again.counts["train"] == again.train.count() == 85


def test_reuse_without_a_benchmark_keeps_all(spark):
    p = jobs.prepare_dataset(labelled(spark, "r", 5), synthetic(spark, 5), reuse_benchmark=True)
    assert p.counts == {"real": 5, "synthetic_used": 5, "train": 10, "benchmark": 0}


def test_hot_text_in_the_pool(spark):
    real = labelled(spark, "hot", 60, text="the same text").unionByName(labelled(spark, "r", 60))
    bench = spark.createDataFrame([("b", "the same text", None)], "id string, text string, expected string")
    p = jobs.prepare_dataset(real, synthetic(spark, 0), fixed_benchmark=bench, reuse_benchmark=True)
    assert p.counts["train"] == p.train.count() == 60


def test_ordered_export_is_a_shuffle_by_seed(spark):
    real = labelled(spark, "r", 50)
    def order(seed):
        p = jobs.prepare_dataset(real, synthetic(spark, 0), holdout_count=0, seed=seed, ordered=True)
        return [r["input"] for r in p.train.collect()]
    assert order(1) == order(1) != order(2)


def test_sft_rows(spark):
    train = jobs.prepare_dataset(labelled(spark, "r", 400), synthetic(spark, 0), holdout_count=0).train
    out = jobs.sft_rows(train, seed=1)
    assert out.columns == ["prompt", "completion"] and out.count() == 400
    many = out.where(F.contains("completion", F.lit("}, {")))
    assert many.where(~F.contains("prompt", F.lit("Hint: there are 2 shipments in this message\n"))).count() == 0
    single = out.where(~F.contains("completion", F.lit("}, {")))
    hinted = single.where(F.contains("prompt", F.lit("Hint: there are 1 shipment in this message\n"))).count()
    assert 40 < hinted < 100
    assert jobs.sft_rows(train, guidance_permille=0).where(
        F.contains("prompt", F.lit("1 shipment"))
    ).count() == 0
    assert out.where(~F.startswith("completion", F.lit('{"items": [{'))).count() == 0


def test_retrain_decision(spark):
    raw = spark.createDataFrame([("1", ONE, ONE), ("2", ONE, TWO)], "id string, expected string, predicted string")
    scored, decision = jobs.retrain_decision(raw, None)
    assert decision.first()["decision"] == "PROMOTED_BASELINE"
    assert jobs.retrain_decision(raw, scored)[1].first()["decision"] == "KEPT"
    better = raw.where("id = 1")
    assert tuple(jobs.retrain_decision(better, scored)[1].first()) == ("PROMOTED", 100.0, 50.0)


def test_retrain_needs_a_benchmark_and_promotes_only_better(spark, tmp_path):
    reviews = spark.createDataFrame(
        [(i, f"text {i % 30}", ONE, None, "2026-01-01", i % 10 == 9) for i in range(60)],
        "id bigint, text string, parsed string, corrected string, reviewed string, exclude boolean",
    ).withColumn("reviewed", F.col("reviewed").cast("timestamp"))
    nothing = spark.createDataFrame([], LABELLED)
    data = stores.DatasetFolder(spark, str(tmp_path / "data"))
    store = stores.PredictionStore(spark, str(tmp_path / "predictions"))
    asked = []

    def answer(share):
        def give(train, fixed):
            asked.append((train.count(), {r["text"] for r in fixed.collect()} & {r["input"] for r in train.collect()}))
            right = F.crc32(F.col("id").cast("binary")) % 100 < share
            answered = fixed.select("*", F.when(right, F.col("expected")).alias("items"), F.lit(None).cast("double").alias("duration"), F.when(~right, "X: no").alias("error"))
            return predictions(answered, "m", "v1")

        return give

    def turn(share):
        return jobs.retrain(reviews, nothing, data, store, answer(share), labels_at=str(tmp_path / f"labels{len(asked)}"), seed=3)

    with pytest.raises(FileNotFoundError, match="benchmark"):
        turn(50)
    assert not asked and store.incumbent() is None
    made = jobs.prepare_dataset(review.trusted_labels(reviews), nothing, holdout_count=20, seed=3)
    data.write(made.train, made.benchmark)
    done = [turn(share) for share in (60, 60, 100, 60)]
    assert [d.decision for d in done] == ["PROMOTED_BASELINE", "KEPT", "PROMOTED", "KEPT"]
    assert done[3].incumbent_pct == 100.0 and done[1].candidate_pct == done[1].incumbent_pct
    assert store.incumbent().where("category = 'CORRECT'").count() == 20 and len(store.snapshots()) == 2
    # None of the benchmark's texts is trained on, and the rows counted are those written.
    assert all(n == done[0].n_train and not shared for n, shared in asked)


def test_the_retrain_cycle_makes_the_queue_once(spark, monkeypatch):
    """What training sets are counted, cut and written from is stored, not made from orders."""
    from ladewerk.plans import queries

    plans = []
    prepare = jobs.prepare_dataset

    def seen(real, *args, **options):
        plans.append(real._jdf.queryExecution().optimizedPlan().toString())
        return prepare(real, *args, **options)

    monkeypatch.setattr(jobs, "prepare_dataset", seen)
    monkeypatch.setattr(queries, "CANDIDATES", ["newer"])
    assert queries.retrain_cycle(spark, "/root/testdata/sf0.001").count() == 1
    assert len(plans) == 2 and not any("o_orderkey" in p for p in plans)
