"""The jobs: each takes tables and gives tables. Writing is left to `sources`,
except where two outputs must be guarded together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladewerk.functions.binding import computed
from ladewerk.functions.draws import chance, digest, draw
from ladewerk.functions.json_text import wrap_items
from ladewerk.functions.text import count_hint, prompt
from ladewerk.functions.validation import parse_lines, whole_value
from ladewerk.operators import gate, label_errors, review, scoring
from ladewerk.operators.contamination import exclude_texts
from ladewerk.operators.selection import (
    fill_missing_ids, find_places, half_even, in_seeded_order, sample_exact, seeded_place, seeded_split,
)
from ladewerk.schema import GATE_COLUMNS, INSTRUCTION, LABELLED
from ladewerk.sources import files, stores

GUIDANCE_PERMILLE = 350


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    benchmark: DataFrame | None
    pool: DataFrame
    counts: dict[str, int]

    def summary(self) -> DataFrame:
        spark = self.pool.sparkSession
        return spark.createDataFrame(
            [tuple(self.counts[k] for k in ("real", "synthetic_used", "train", "benchmark"))],
            "real bigint, synthetic_used bigint, train bigint, benchmark bigint",
        )


def instruction_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.lit(INSTRUCTION).alias("instruction"),
        F.col("text").alias("input"),
        F.col("parsed_json").alias("output"),
    )


def benchmark_rows(rows: DataFrame, seed: int, any_missing: bool | None = None) -> DataFrame:
    named = fill_missing_ids(rows, seed, any_missing=any_missing)
    return computed(named, parse_lines("parsed_json").alias("expected")).select(
        F.col("id").cast("string").alias("id"), "text", "expected"
    )


def prepare_dataset(
    real: DataFrame, synthetic: DataFrame, *, synthetic_ratio: float = 4.0,
    holdout_percent: float = 15.0, holdout_count: int | None = None,
    max_train: int | None = None, seed: int = 0, fixed_benchmark: DataFrame | None = None,
    reuse_benchmark: bool = False, ordered: bool = False,
) -> Prepared:
    """Instruction rows for training and a held-out benchmark of exact size.

    Synthetic rows are sampled to `synthetic_ratio` per real row. With
    `reuse_benchmark` the fixed benchmark stays and none of its texts is trained on.
    `max_train`, off by default, keeps that many training rows, chosen by seeded hash;
    the benchmark is settled before it.
    """
    # Each synthetic row has a place in the order it is sampled by, each row of the pool one
    # in the order it is split by. The first pass counts, the second finds all cuts.
    drawn = synthetic.select("*", seeded_place(synthetic, seed, tag="sample").alias("_sample"))
    tagged = real.select("*", F.lit("real").alias("source"), F.lit(None).cast("bigint").alias("_sample")).unionByName(
        drawn.withColumn("source", F.lit("synthetic")), allowMissingColumns=True
    )
    columns = [c for c in tagged.columns if c != "_sample"]
    place = seeded_place(tagged, seed, columns=columns)
    seen = tagged.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("id").isNull()).alias("unnamed")).collect()
    sizes = {r["source"]: r["n"] for r in seen}
    any_missing = any(r["unnamed"] for r in seen)
    n_real, n_synthetic = sizes.get("real", 0), sizes.get("synthetic", 0)
    target = half_even(n_real * synthetic_ratio)
    sample = target if n_real and n_synthetic > target else None
    n = n_real + (n_synthetic if sample is None else sample)
    wanted = (
        holdout_count if holdout_count is not None else max(1, half_even(n * holdout_percent / 100.0))
    )
    n_benchmark = 0 if reuse_benchmark else min(wanted, n)
    n_train = n - n_benchmark
    capped = max_train is not None and n_train > max_train
    ranks = [n_benchmark, n_benchmark + max_train if capped else n]
    cuts = sorted({r for r in ranks if 0 < r < n}) if not reuse_benchmark else []
    found = (None, [])
    if sample or cuts:
        offered = tagged.where(F.col("source") == "real") if sample == 0 else tagged
        found = find_places(offered.select("_sample", place.alias("_place")), n_synthetic, sample or None, n, cuts)
    if found is None:
        # Rows share a place, or there are too many near one: step by step.
        if sample is not None:
            synthetic = sample_exact(synthetic, sample, seed)
    elif sample is not None:
        synthetic = drawn.where(F.col("_sample") <= found[0]).drop("_sample") if sample else synthetic.where(F.lit(False))
    pool = real.withColumn("source", F.lit("real")).unionByName(
        synthetic.withColumn("source", F.lit("synthetic")), allowMissingColumns=True
    )
    benchmark = None
    if reuse_benchmark:
        train = pool if fixed_benchmark is None else exclude_texts(pool, fixed_benchmark)
        n_train = train.count() if fixed_benchmark is not None else n
        capped = max_train is not None and n_train > max_train
        if capped:
            train = seeded_split(train, max_train, seed)[0]
    elif found is None:
        held, train = seeded_split(pool, n_benchmark, seed)
        benchmark = benchmark_rows(held, seed, any_missing)
        if capped:
            train = seeded_split(train, max_train, seed)[0]
    else:
        # The ends need no place: before the first row, and after the last.
        ends = {0: -1, n: 1 << 60, **dict(zip(cuts, found[1], strict=True))}
        benchmark = benchmark_rows(pool.where(place <= ends[ranks[0]]), seed, any_missing)
        train = pool.where((place > ends[ranks[0]]) & (place <= ends[ranks[1]]))
    counts = {
        "real": n_real, "synthetic_used": n - n_real,
        "train": max_train if capped else n_train, "benchmark": n_benchmark,
    }
    shuffled = in_seeded_order(train, seed) if ordered else train
    return Prepared(instruction_rows(shuffled), benchmark, train, counts)


def sft_rows(
    train: DataFrame, seed: int = 0, guidance_permille: int = GUIDANCE_PERMILLE,
) -> DataFrame:
    """Prompt and completion of each instruction row. A true count hint goes to
    every list of several lines and to a seeded share of the others. An output that is
    not one JSON list fails the job."""
    read = F.size(F.try_variant_get(whole_value("output"), "$", "array<variant>"))
    broken = F.raise_error(F.concat(F.lit("not one JSON list: "), F.substring("output", 1, 200)))
    n = F.when(read.isNull() | (read < 0), broken).otherwise(read)
    counted = computed(
        train, n.alias("_n"), draw(digest(seed, F.col("input"), "hint"), 0).alias("_d")
    )
    hinted = (F.col("_n") > 1) | chance(F.col("_d"), guidance_permille)
    return counted.select(
        prompt(F.col("input"), F.when(hinted, count_hint(F.col("_n")))).alias("prompt"),
        wrap_items(F.col("output")).alias("completion"),
    )


def load_reviews(
    spark: SparkSession, seed_path: str, store: stores.ReviewStore, work: str, *,
    now: Column, auto_review: bool = False, fraction: tuple[int, int] | None = None,
) -> DataFrame:
    """Replace the review queue by the rows of a seed file, some with a deliberate error,
    and report which row shows which: row_idx, id, kind.

    By default each kind of error goes to the first row it suits; `fraction` (permille,
    seed) draws rows instead. A broken line stops the load with its file and line, before
    the queue is touched. What is parsed is kept in the folder `work`.
    """
    rows = files.read_seed(spark, seed_path, f"{work}/seed")
    if fraction is None:
        planned = label_errors.with_plan(rows, label_errors.plan_first_suitable(rows))
    else:
        planned = label_errors.with_fraction(rows, *fraction)
    store.reload(label_errors.review_rows(planned, auto_review=auto_review, now=now))
    return label_errors.injected_errors(planned)


def gate_files(spark: SparkSession, glob: str) -> tuple[DataFrame, DataFrame]:
    """(category breakdown of each file, ranking of the models) of scored JSON-lines files.
    The breakdown goes by the files' names, the ranking by what their rows say."""
    rows = files.read_gate_files(spark, glob, GATE_COLUMNS)
    named = rows.select(F.col("file_model").alias("model_name"), "category")
    return gate.category_breakdown(named), gate.comparison_table(rows)


def retrain_decision(
    candidate_raw: DataFrame, incumbent_scored: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """(scored candidate, one-row decision) of stored predictions."""
    scored = scoring.score(candidate_raw)
    return scored, gate.gate_decision(scored, incumbent_scored)


@dataclass(frozen=True)
class Retrained:
    run: str
    decision: str
    candidate_pct: float
    incumbent_pct: float | None
    n_train: int
    n_benchmark: int


def retrain(
    reviews: DataFrame, synthetic: DataFrame, data: stores.DatasetFolder,
    store: stores.PredictionStore, answer: Callable[[DataFrame, DataFrame], DataFrame],
    *, labels_at: str, seed: int = 0, max_train: int | None = None,
) -> Retrained:
    """One turn of the loop: labels, training set, a candidate's answers, the decision.

    The stored benchmark stays as it is, and without one nothing is done. The training set
    is rebuilt from the trusted labels, which are kept at `labels_at`, and none of the
    benchmark's texts is in it. `answer` is given training set and benchmark and gives the
    candidate's raw predictions; they are evaluated once, and scored, compared and promoted
    as they were stored. Only a strictly better candidate replaces the incumbent.
    """
    spark = reviews.sparkSession
    fixed = data.fixed_benchmark()
    if fixed is None:
        raise FileNotFoundError(f"no benchmark at {data.benchmark_path}: prepare a dataset first")
    review.trusted_labels(reviews).write.parquet(labels_at)
    real = spark.read.schema(LABELLED).parquet(labels_at)
    made = prepare_dataset(
        real, synthetic, seed=seed, max_train=max_train, fixed_benchmark=fixed, reuse_benchmark=True
    )
    data.write(made.train, None, force=True)
    run = store.record(answer(data.train(), fixed))
    scored = store.scored(run)
    row = gate.gate_decision(scored, store.incumbent()).first()
    if row["decision"] != "KEPT":
        store.promote(scored)
    return Retrained(
        run, row["decision"], row["candidate_pct"], row["incumbent_pct"],
        made.counts["train"], fixed.count(),
    )
