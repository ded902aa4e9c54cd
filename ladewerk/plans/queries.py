"""The registered queries: each takes (spark, folder) and runs over whole tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladewerk.functions.binding import computed
from ladewerk.functions.json_text import items_json, lines_json, string_text
from ladewerk.functions.text import count_hint, preview, prompt
from ladewerk.functions.validation import (
    date_ladder_ok, guard_references, in_vocabulary, one_reference, parse_items, parse_lines,
    reference_unsupported, review_row_valid,
)
from ladewerk.operators import extract as X
from ladewerk.operators import gate, generate, label_errors, review, scoring
from ladewerk.operators.contamination import exclude_texts
from ladewerk.operators.joins import join_unique
from ladewerk.operators.registry import registry_table, resolve_models
from ladewerk.operators.selection import seeded_parts
from ladewerk.plans import jobs
from ladewerk.plans import tables as B
from ladewerk.schema import EXAMPLES_EXPORT, GATE_COLUMNS, LABELLED
from ladewerk.session import in_order, work_folder
from ladewerk.sources import files, stores
from ladewerk.sources.positions import numbered_lines
from ladewerk.sources.search import SearchStore

SEED = 7
FRACTION_PERMILLE = 250
NOW = "2026-01-01 00:00:00"
DECISIONS = [("newer", "older"), ("older", "newer"), ("newer", "newer"), ("production", None)]
#: Models that try to replace the incumbent, in turn.
CANDIDATES = ["older", "newer", "older", "production"]
REGISTRY = [
    {"name": "click", "base": "base-a", "has_adapter": True},
    {"name": "newer", "base": "base-b", "has_adapter": True},
    {"name": "view", "base": "base-c", "has_adapter": False},
    {"name": "error", "base": "base-d", "has_adapter": False},
]


def confirmations(spark: SparkSession, folder: str) -> DataFrame:
    return B.confirmations(B.table(spark, folder, "orders"))


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return B.predictions(confirmations(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score(_raw(spark, folder))


def _reviews(spark: SparkSession, folder: str) -> DataFrame:
    return B.reviews(confirmations(spark, folder))


def _examples(spark: SparkSession, folder: str, by_id: bool = False) -> DataFrame:
    orders = B.table(spark, folder, "orders")
    if by_id:
        orders = in_order(orders, generate.example_id(SEED, "o_orderkey"))
    return generate.generate_from(orders, SEED, index="o_orderkey")


def _rounded(ranking: DataFrame) -> DataFrame:
    return ranking.select(
        "model_name", "version", F.round("pct_correct", 4).alias("pct_correct"),
        F.round("pct_fields", 4).alias("pct_fields"), "n", "avg_seconds",
    )


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- scoring and gate ---------------------------------------------------------
def gate_report(spark, folder):
    """Which model ships: score every prediction, then rank the models."""
    return _rounded(gate.comparison_table(_scored(spark, folder)))


def gate_winner(spark, folder):
    return _rounded(gate.winner(_scored(spark, folder)))


def gate_event_log(spark, folder):
    return _rounded(gate.comparison_table(B.event_log(B.table(spark, folder, "events"))))


def breakdown_event_log(spark, folder):
    return gate.category_breakdown(B.event_log(B.table(spark, folder, "events")))


def score_rows(spark, folder):
    return _scored(spark, folder).select(
        "id", "model_name", "category", "field_accuracy",
        scoring.is_accurate(F.col("category")).alias("accurate"),
    )


def score_json_text(spark, folder):
    """The same scoring from JSON text columns, validated on the way."""
    raw = _raw(spark, folder)
    gold_text = computed(
        raw.select("id", "model_name", "expected", "predicted", "error"), lines_json("expected").alias("e"),
    )
    # Equal lists have one text.
    as_text = computed(
        gold_text, F.when(F.col("predicted") == F.col("expected"), F.col("e")).otherwise(lines_json("predicted")).alias("p"),
    ).select("id", "model_name", F.col("e").alias("expected"), F.col("p").alias("predicted"), "error")
    return scoring.score(as_text).select("id", "model_name", "category", "field_accuracy")


def score_bucketed_gold(spark, folder):
    """Gold and predictions stored in buckets of their id: scored without a shuffle."""
    confirmed = confirmations(spark, folder)
    gold = confirmed.select(F.col("id").cast("string").alias("id"), F.col("gold").alias("expected"))
    read = []
    buckets = stores.buckets_for(B.table(spark, folder, "orders").count())
    for kind, rows in (("gold", gold), ("predicted", B.predictions(confirmed).drop("expected"))):
        store = stores.BucketedStore(spark, f"{kind}_{uuid.uuid4().hex}", _new_folder(spark, kind), buckets=buckets)
        store.replace(rows)
        read.append(store.read())
    raw = scoring.attach_bucketed(read[1], read[0])
    return scoring.score(raw).select("id", "model_name", "category", "field_accuracy")


def score_attached_gold(spark, folder):
    """Gold stored once, joined to the predictions by id."""
    confirmed = confirmations(spark, folder)
    gold = confirmed.select(F.col("id").cast("string").alias("id"), F.col("gold").alias("expected"))
    # Without the texts: a side too large to broadcast is spread by all of its columns.
    raw = scoring.attach_gold(B.predictions(confirmed).drop("expected", "text"), gold)
    return scoring.score(raw).select("id", "model_name", "category", "field_accuracy")


def category_breakdown(spark, folder):
    return gate.category_breakdown(_scored(spark, folder))


def outcome_counts(spark, folder):
    return gate.outcome_counts(_scored(spark, folder))


def gate_decisions(spark, folder):
    return gate.gate_decisions(_scored(spark, folder), DECISIONS).select(
        "candidate", "decision", F.round("candidate_pct", 6).alias("candidate_pct"),
        F.round("incumbent_pct", 6).alias("incumbent_pct"),
    )


# --- JSON and validation --------------------------------------------------------
def canonical_json(spark, folder):
    return confirmations(spark, folder).select("id", lines_json("gold").alias("parsed_json"))


def message_text(spark, folder):
    return confirmations(spark, folder).select("id", "text")


def validate_labels(spark, folder):
    """Each review label as read: valid or not, and its canonical text."""
    read = computed(_reviews(spark, folder), parse_lines("parsed").alias("lines"))
    return read.select(
        "id", F.col("lines").isNotNull().alias("valid"), lines_json("lines").alias("canonical")
    )


def review_row_validity(spark, folder):
    return _reviews(spark, folder).select(
        "id", review_row_valid("parsed", "corrected").alias("valid")
    )


def decode_items(spark, folder):
    """Wrap, read back, write again."""
    wrapped = computed(confirmations(spark, folder).select("id", "gold"), items_json("gold").alias("raw"))
    return computed(wrapped, parse_items("raw").alias("lines")).select(
        "id", lines_json("lines").alias("parsed_json")
    )


def reference_guard(spark, folder):
    raw = _raw(spark, folder).where(F.col("predicted").isNotNull())
    return raw.select(
        "id", "model_name",
        lines_json(guard_references(F.col("predicted"), F.col("text"))).alias("guarded"),
        reference_unsupported(F.col("predicted"), F.col("text")).alias("fired"),
    )


def label_rules(spark, folder):
    """Violations per model of the closed vocabulary, the date ladder, the
    reference rule and the one-reference rule."""
    # An empty error is none.
    sound = F.coalesce(F.col("error"), F.lit("")) == ""
    raw = _raw(spark, folder).where(F.col("predicted").isNotNull() & sound)
    p = F.col("predicted")
    return raw.groupBy("model_name").agg(
        F.count("*").alias("n"),
        F.count_if(~F.coalesce(in_vocabulary(p), F.lit(False))).alias("outside_vocabulary"),
        F.count_if(~date_ladder_ok(p)).alias("bad_date_ladder"),
        F.count_if(reference_unsupported(p, F.col("text"))).alias("unsupported_reference"),
        F.count_if(~one_reference(p)).alias("several_references"),
    )


# --- prompts ----------------------------------------------------------------------
def prompts(spark, folder):
    chat = B.table(spark, folder, "conversations")
    guidance = F.when(F.col("turn") % 3 == 0, count_hint(F.col("turn"))).when(
        F.col("turn") % 3 == 1, F.concat(F.lit(" \n\t"), F.col("role"), F.lit("\n "))
    ).when(F.col("turn") % 3 == 2, F.lit(""))
    return chat.select("conv_id", "turn", prompt(F.col("text"), guidance).alias("prompt"))


# --- review -------------------------------------------------------------------------
def trusted_export(spark, folder):
    return review.trusted_labels(_reviews(spark, folder))


def trusted_export_counts(spark, folder):
    return review.export_counts(_reviews(spark, folder))


def trusted_document_labels(spark, folder):
    """The trusted-label filter on the label table: quality is the sign-off, toxic
    the exclude flag."""
    flags = B.table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality") == 1, F.lit(NOW).cast("timestamp")).alias("reviewed"),
        (F.col("toxic") == 1).alias("exclude"),
    )
    return review.trusted(flags).select("id")


def review_queue(spark, folder):
    return review.queue(_reviews(spark, folder)).select(
        "id", "short_text", F.col("reviewed").isNotNull().alias("is_reviewed"), "has_correction", "exclude"
    )


def review_queue_filtered(spark, folder):
    return review.queue(_reviews(spark, folder), corrected="yes", reviewed=True, exclude=False).select(
        "id", "short_text"
    )


def review_search(spark, folder):
    return review.queue(_reviews(spark, folder), search="Run SHEET kestrel", corrected="no").select("id", "short_text")


def chat_search(spark, folder):
    chat = B.table(spark, folder, "conversations")
    return chat.where(review.has_words(F.col("text"), "THE re")).select(
        "conv_id", "turn", preview(F.col("text")).alias("short_text")
    )


def indexed_search(spark, folder):
    """A rare word, looked for only in the files that can hold it."""
    store = SearchStore(spark, _new_folder(spark, "search"))
    store.replace(confirmations(spark, folder).select("id", "text"), rows_per_file=200)
    return store.search("po-117 MOVERS").select("id", preview(F.col("text")).alias("short_text"))


def next_unreviewed(spark, folder):
    """The next open row after the middle and after the end of the queue."""
    rows = _reviews(spark, folder).select("id", "reviewed")
    middle, end = rows.agg(F.floor(F.avg("id")), F.max("id")).first()
    return (
        review.next_unreviewed(rows, middle).select(F.lit("middle").alias("after"), "next_id")
        .unionByName(review.next_unreviewed(rows, end).select(F.lit("end").alias("after"), "next_id"))
    )


# --- label errors -----------------------------------------------------------------
def _seed_rows(spark, folder):
    return confirmations(spark, folder).select(F.col("id").alias("row_idx"), "id", "text", "gold")


def _loaded(planned: DataFrame, auto_review: bool) -> DataFrame:
    return label_errors.review_rows(
        planned, auto_review=auto_review, now=F.lit(NOW).cast("timestamp")
    ).select(
        "id", "parsed", "corrected", F.col("reviewed").isNotNull().alias("is_reviewed"), "exclude"
    )


def review_load(spark, folder):
    rows = _seed_rows(spark, folder)
    return _loaded(label_errors.with_plan(rows, label_errors.plan_first_suitable(rows)), False)


def review_load_reviewed(spark, folder):
    rows = _seed_rows(spark, folder)
    return _loaded(label_errors.with_plan(rows, label_errors.plan_first_suitable(rows)), True)


def review_load_plan(spark, folder):
    rows = _seed_rows(spark, folder)
    planned = label_errors.with_plan(rows, label_errors.plan_first_suitable(rows))
    return label_errors.injected_errors(planned).select("row_idx", "kind")


def seed_file_load(spark, folder):
    """A seed file of many parts, with blank lines, read by line number into the queue."""
    where = _new_folder(spark, "seed")
    orders = in_order(B.table(spark, folder, "orders"), F.col("o_orderkey"))
    rows = B.confirmations(orders).select("id", "text", "gold")
    line = F.concat(
        F.lit('{"id": '), string_text(F.format_string("seed-%03d", "id")), F.lit(', "text": '), string_text(F.col("text")), F.lit(', "gold": '), lines_json("gold"), F.lit("}"),
    )
    blank = F.when(F.col("id") % 7 == 0, F.lit("  ")).when(F.col("id") % 5 == 0, F.lit(""))
    rows.select(F.explode(F.array_compact(F.array(blank, line))).alias("value")).write.text(f"{where}/seed.jsonl")
    store = stores.ReviewStore(spark, f"{where}/reviews")
    jobs.load_reviews(
        spark, f"{where}/seed.jsonl", store, f"{where}/work", now=F.lit(NOW).cast("timestamp"), auto_review=True
    )
    return store.read().select(
        "id", "text", "parsed", "corrected", F.col("reviewed").isNotNull().alias("is_reviewed"), "exclude"
    )


def _fraction(spark, folder):
    return label_errors.with_fraction(_seed_rows(spark, folder), FRACTION_PERMILLE, SEED)


def review_load_fraction(spark, folder):
    return _loaded(_fraction(spark, folder), True)


def review_load_report(spark, folder):
    return label_errors.load_report(_fraction(spark, folder))


def label_audit(spark, folder):
    """Error classes of the corrupted labels against gold."""
    planned = _fraction(spark, folder)
    proposed = computed(planned, label_errors.corrupt("kind", "gold").alias("proposed"))
    return label_errors.audit(proposed).select("id", "error_class", "unsupported_reference", "guarded")


# --- generation -------------------------------------------------------------------
def synth_generate(spark, folder):
    return _examples(spark, folder).select("id", "text", "parsed_json", "style", "complexity")


def synth_export(spark, folder):
    return stores.export_rows(_examples(spark, folder, by_id=True), by_id=True)


def synth_sample(spark, folder):
    return stores.ordered_sample(_examples(spark, folder).drop("lines"), 25)


def synth_difficulty(spark, folder):
    return generate.difficulty(_examples(spark, folder))


def synth_store_round_trip(spark, folder):
    """Replace the stored table, export it as JSON lines, read that back."""
    where = _new_folder(spark, "examples")
    store = stores.ExampleStore(spark, f"{where}/table")
    store.replace(_examples(spark, folder))
    store.export_jsonl(f"{where}/jsonl")
    return files.read_jsonl(spark, f"{where}/jsonl", EXAMPLES_EXPORT)


def synth_count(spark, folder):
    """Rows of the stored table, by its count and by what its writer counted."""
    store = stores.ExampleStore(spark, _new_folder(spark, "examples"))
    written = store.replace(_examples(spark, folder))
    return spark.createDataFrame([(written, store.count())], "written bigint, n bigint")


def synth_invariants(spark, folder):
    """Violations in generated labels; every count must be zero."""
    e = F.col("lines")
    made = _examples(spark, folder)
    return made.agg(
        F.count("*").alias("n"),
        F.count_if(~date_ladder_ok(e)).alias("bad_date_ladder"),
        F.count_if(reference_unsupported(e, F.col("text"))).alias("unsupported_reference"),
        F.count_if(~one_reference(e)).alias("several_references"),
        F.count_if(~in_vocabulary(e)).alias("outside_vocabulary"),
        F.count_if((F.col("style") == "multileg") != (F.size(e) > 1)).alias("wrong_line_count"),
    )


# --- dataset preparation --------------------------------------------------------------
def _prepared(spark, folder, **options):
    docs = B.table(spark, folder, "documents")
    return jobs.prepare_dataset(
        B.text_pool(docs, real=True), B.text_pool(docs, real=False), seed=SEED, **options
    )


def train_set(spark, folder):
    return _prepared(spark, folder, synthetic_ratio=2.5).train


def benchmark_set(spark, folder):
    return _prepared(spark, folder, synthetic_ratio=2.5).benchmark.select(
        "id", "text", lines_json("expected").alias("expected")
    )


def prep_summary(spark, folder):
    return _prepared(spark, folder, synthetic_ratio=2.5).summary()


def retrain_set(spark, folder):
    """The fixed benchmark stays out of a rebuilt training set, copies included."""
    fixed = _prepared(spark, folder, synthetic_ratio=2.5).benchmark
    return _prepared(
        spark, folder, synthetic_ratio=4.0, fixed_benchmark=fixed, reuse_benchmark=True
    ).train


def capped_train_set(spark, folder):
    return _prepared(spark, folder, synthetic_ratio=2.5, holdout_count=0, max_train=100).train


def contamination_left(spark, folder):
    """Training texts that are also benchmark texts: none may remain."""
    fixed = _prepared(spark, folder, synthetic_ratio=2.5).benchmark
    docs = B.table(spark, folder, "documents")
    kept = exclude_texts(docs, fixed)
    return kept.agg(F.count("*").alias("kept"), F.count_distinct("text").alias("kept_texts"))


def seeded_export(spark, folder):
    """Training rows written in seeded order as numbered parts, and read back by line."""
    made = _prepared(spark, folder, synthetic_ratio=2.5, holdout_count=0)
    shuffled = seeded_parts(made.pool.select("id", "text", "parsed_json"), SEED, rows_per_part=1_000)
    path = _new_folder(spark, "export") + "/train.jsonl"
    files.write_jsonl(shuffled, path)
    lines = numbered_lines(spark, path)
    row = F.from_json("line", LABELLED)
    return lines.select("row_idx", row.getField("id").alias("id"), row.getField("text").alias("text"))


def pool_sources(spark, folder):
    """Where the rows of the pool come from, before the benchmark is held out."""
    pool = _prepared(spark, folder, synthetic_ratio=2.5, holdout_count=0).pool
    return pool.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


def sft_rows(spark, folder):
    return jobs.sft_rows(_prepared(spark, folder, synthetic_ratio=2.5).train, SEED)


# --- extraction ---------------------------------------------------------------------
def extract_full(spark, folder):
    """Lines read back from generated text; the label they were written from is
    what the SQL side gives."""
    return X.extract(_examples(spark, folder).select("id", "text"), "full").select(
        "id", lines_json("items").alias("parsed_json"), "reference_guarded", "error"
    )


def extract_confirmations(spark, folder):
    return X.extract(confirmations(spark, folder).select("id", "text"), "full").select(
        "id", lines_json("items").alias("parsed_json")
    )


def extract_clean(spark, folder):
    return X.extract(_examples(spark, folder).select("id", "text"), "clean").select(
        "id", lines_json("items").alias("parsed_json"), "reference_guarded", "error"
    )


def _extractor_runs(spark, folder):
    # A text is written once and read by both rule sets.
    models = F.explode(F.array(F.lit("clean"), F.lit("full"))).alias("model")
    asked = _examples(spark, folder).select("id", "text", F.col("lines").alias("expected"), models)
    entries = [{"name": m, "base": m, "has_adapter": True} for m in ("clean", "full")]
    answered = X.parse(asked, registry_table(spark, entries, default="full", env={}), {"clean": "clean", "full": "full"}, default="full")
    return X.predictions(answered, F.col("requested_model"), "v1")


def extractor_gate(spark, folder):
    """Two rule sets on the same texts, scored and ranked."""
    return _rounded(gate.comparison_table(scoring.score(_extractor_runs(spark, folder))))


def parse_batch(spark, folder):
    """Requests answered as a batch job, fallbacks included."""
    asked = confirmations(spark, folder).select(
        "id", "text",
        F.when(F.col("id") % 5 == 0, "click").when(F.col("id") % 5 == 1, "view")
        .when(F.col("id") % 5 == 2, "ghost").when(F.col("id") % 5 == 3, "").alias("model"),
    )
    rules = {"click": "full", "newer": "full"}
    return X.parse(asked, registry_table(spark, REGISTRY, env={}), rules).select(
        "id", "requested_model", "effective_model", "fell_back",
        lines_json("items").alias("parsed_json"), "reference_guarded", "error",
    )


def dataset_folder(spark, folder):
    """Both outputs written under one guard, the benchmark read back."""
    data = stores.DatasetFolder(spark, _new_folder(spark, "dataset"))
    made = _prepared(spark, folder, synthetic_ratio=2.5)
    data.write(made.train, made.benchmark)
    return data.benchmark().select("id", "text", lines_json("expected").alias("expected"))


def parse_requests(spark, folder):
    """Requests that name a model: who answers, and whether that is a fallback."""
    asked = B.table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 7 == 0, "").when(F.col("event_id") % 11 == 0, None)
        .otherwise(F.col("event_type")).alias("model"),
    )
    return resolve_models(asked, registry_table(spark, REGISTRY, env={})).select(
        "event_id", "requested_model", "effective_model", "fell_back"
    )


def sample_model(prompts: list[str]) -> list[str]:
    """A caller's model for the hook: counts the stated legs, refuses some texts."""
    out = []
    for p in prompts:
        message = p.split("Confirmation:\n", 1)[1]
        if "ref " in message:
            raise ValueError("a reference is stated")
        line = {"quantity": len(message.split("\n")) - 1, "unit": "pallets", "leg": "pickup",
                "rate": 1.5, "reference": "PO-INVENTED"}
        out.append(json.dumps({"items": [line]}))
    return out


def extract_external(spark, folder):
    """Any Python model over the same rows, with its errors kept per row."""
    return X.extract_with(confirmations(spark, folder).select("id", "text"), sample_model).select(
        "id", lines_json("items").alias("parsed_json"), "reference_guarded", "error"
    )


# --- files, stores and the closed loop ------------------------------------------------
def gate_from_store(spark, folder):
    """Predictions written as raw and scored tables; the gate reads five columns."""
    store = stores.PredictionStore(spark, _new_folder(spark, "predictions"))
    store.write(_scored(spark, folder))
    return _rounded(gate.comparison_table(store.scored().select(*GATE_COLUMNS.fieldNames())))


def _gate_files(spark, folder):
    where = _new_folder(spark, "gate")
    scored = _scored(spark, folder).select(*GATE_COLUMNS.fieldNames(), "id", "expected", "predicted")
    files.write_gate_files(scored, where)
    return jobs.gate_files(spark, f"{where}/*.jsonl")


def gate_from_files(spark, folder):
    """Models ranked from scored JSON-lines files, one per model."""
    return _rounded(_gate_files(spark, folder)[1])


def breakdown_from_files(spark, folder):
    """Category counts of each file, the model named by the file."""
    return _gate_files(spark, folder)[0]


def export_round_trip(spark, folder):
    """Trusted labels through a JSON-lines file."""
    path = _new_folder(spark, "labels") + "/jsonl"
    # The id of a label is the order's key as text.
    orders = in_order(B.table(spark, folder, "orders"), F.col("o_orderkey").cast("string"))
    files.write_jsonl(review.trusted_labels(B.reviews(B.confirmations(orders))), path)
    return files.read_jsonl(spark, path, LABELLED)


def retrain_cycle(spark, folder):
    """The loop, four times: labels, training set around the fixed benchmark, a candidate's
    answers recorded once, the decision against the incumbent."""
    where = _new_folder(spark, "retrain")
    store = stores.PredictionStore(spark, f"{where}/predictions")
    data = stores.DatasetFolder(spark, f"{where}/dataset")
    # The queue is written and read once a step, not made anew from the orders; so are the
    # labels that the first training set is counted, cut and written from.
    queue = stores.ReviewStore(spark, f"{where}/reviews")
    queue.reload(_reviews(spark, folder))
    reviews = queue.read()
    nothing = spark.createDataFrame([], LABELLED)
    review.trusted_labels(reviews).write.parquet(f"{where}/labels-first")
    first = jobs.prepare_dataset(
        spark.read.schema(LABELLED).parquet(f"{where}/labels-first"), nothing, holdout_percent=20.0, seed=SEED
    )
    data.write(first.train, first.benchmark)
    # A candidate answers what the benchmark asks.
    asked = data.benchmark().select("id").distinct()
    orders = B.table(spark, folder, "orders").withColumn("id", F.col("o_orderkey").cast("string"))
    confirmed = B.confirmations(join_unique(orders, asked, ["id"], "inner").drop("id"))
    steps = []
    for model in CANDIDATES:
        made = B.predictions(confirmed).where(F.col("model_name") == model).drop("expected", "text")
        done = jobs.retrain(
            reviews, nothing, data, store,
            lambda train, fixed, made=made: scoring.attach_gold(made, fixed.select("id", "expected")).withColumn("text", F.lit(None).cast("string")),
            labels_at=f"{where}/labels-{len(steps)}", seed=SEED,
        )
        pcts = [None if p is None else round(p, 6) for p in (done.candidate_pct, done.incumbent_pct)]
        steps.append((len(steps), model, done.decision, *pcts, done.n_train, done.n_benchmark))
    return spark.createDataFrame(
        steps, "step int, model string, decision string, candidate_pct double, incumbent_pct double, "
        "n_train bigint, n_benchmark bigint",
    )


QUERIES = {
    f.__name__: f
    for f in (
        gate_report, gate_winner, gate_event_log, breakdown_event_log, score_rows, score_json_text,
        score_attached_gold, category_breakdown, outcome_counts, gate_decisions, canonical_json, message_text,
        validate_labels, review_row_validity, decode_items, reference_guard, label_rules, prompts,
        trusted_export, trusted_export_counts, trusted_document_labels, review_queue,
        review_queue_filtered, review_search, chat_search, next_unreviewed, review_load,
        review_load_reviewed, review_load_plan, review_load_fraction, review_load_report,
        label_audit, synth_generate, synth_export, synth_sample, synth_difficulty,
        synth_store_round_trip, synth_invariants, train_set, benchmark_set, prep_summary,
        retrain_set, capped_train_set, contamination_left, sft_rows, extract_full,
        extract_confirmations, extract_clean, extractor_gate, parse_requests,
        parse_batch, dataset_folder, extract_external,
        gate_from_store, export_round_trip, retrain_cycle,
        seed_file_load, seeded_export, indexed_search, score_bucketed_gold, gate_from_files, breakdown_from_files, pool_sources, synth_count,
    )
}
