"""The shape of the physical plans: what must not shuffle, and what must be pruned."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladewerk.operators import extract, gate, label_errors, review, scoring
from ladewerk.operators.generate import generate
from ladewerk.operators.review import trusted
from ladewerk.plans import tables
from ladewerk.schema import GATE_COLUMNS, LINES, PREDICTIONS, REVIEWS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture()
def stored(spark, tmp_path):
    def make(schema, name):
        path = str(tmp_path / name)
        spark.createDataFrame([], schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return make


def test_row_local_jobs_never_shuffle(spark, stored):
    reviews = stored(REVIEWS, "reviews")
    raw = stored(PREDICTIONS, "raw").drop("category", "field_accuracy")
    made = generate(spark, 10, 1)
    for df in (
        scoring.score(raw), review.trusted_labels(reviews), review.queue(reviews, search="a b"),
        made, extract.extract(made.select("id", "text")), tables.predictions(raw.select("id", "text", F.col("expected").alias("gold"))),
    ):
        assert "Exchange" not in plan(df)


def test_gate_reads_five_columns_and_aggregates_before_the_exchange(spark, stored):
    p = plan(gate.comparison_table(stored(PREDICTIONS, "p")))
    read = re.search(r"ReadSchema: struct<(.*?)>", formatted(gate.comparison_table(stored(PREDICTIONS, "q")))).group(1)
    assert sorted(c.split(":")[0] for c in read.split(",")) == sorted(GATE_COLUMNS.fieldNames())
    assert p.count("HashAggregate") == 2
    assert "partial_avg" in p and "SinglePartition" not in p


def test_trusted_filter_is_pushed_to_the_scan(stored):
    text = formatted(trusted(stored(REVIEWS, "r")))
    assert "PushedFilters" in text and "IsNotNull(reviewed)" in text and "exclude" in text.split("PushedFilters")[1]


def test_labels_alone_do_not_write_the_text(spark):
    p = generate(spark, 10, 1).select("parsed_json")._jdf.queryExecution().optimizedPlan().toString()
    assert "run sheet" not in p


def test_filter_on_a_category_does_not_copy_the_comparison(spark, stored):
    raw = stored(PREDICTIONS, "s").drop("category", "field_accuracy")
    df = scoring.score(raw).where("category = 'CORRECT'")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("zip_with") == 1


def test_top_k_is_not_a_full_sort(spark):
    from ladewerk.sources.stores import ordered_sample

    assert "TakeOrderedAndProject" in plan(ordered_sample(generate(spark, 10, 1), 5))


def test_first_suitable_rows_take_one_scan(spark, stored):
    rows = stored(T.StructType([T.StructField("row_idx", T.LongType()), T.StructField("gold", LINES)]), "seed")
    jobs = []
    tracker, group = spark.sparkContext.statusTracker(), "plan-one-scan"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert label_errors.plan_first_suitable(rows) == {}
        jobs = tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) <= 2  # the pass, and what it hands on


def test_first_suitable_rows_are_cut_before_the_exchange(spark, stored):
    rows = stored(T.StructType([T.StructField("at", T.LongType()), T.StructField("kind", T.StringType())]), "offered")
    place = F.row_number().over(Window.partitionBy("kind").orderBy("at"))
    p = plan(rows.withColumn("_place", place).where("_place <= 4"))
    assert p.index("Final") < p.index("Exchange") < p.index("Partial")


def test_decisions_of_many_pairs_read_once(spark, stored):
    pairs = [("a", "b"), ("b", "a"), ("a", None), ("c", "a"), ("a", "c")]
    assert plan(gate.gate_decisions(stored(PREDICTIONS, "d"), pairs)).count("FileScan") == 1
