"""Stored tables: examples, reviews, predictions and the promoted snapshot."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladewerk.functions.json_text import lines_json, string_text
from ladewerk.operators import scoring
from ladewerk.schema import BENCHMARK, EXAMPLES, PREDICTIONS, PREDICTIONS_RAW, REVIEWS, TRAIN
from ladewerk.sources import files
from ladewerk.sources.versions import ManifestLog, new_version


def _write_counted(df: DataFrame, path: str) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


@dataclass(frozen=True)
class ExampleStore:
    """Generated examples; each write is a full rebuild from its seed."""

    spark: SparkSession
    path: str

    def replace(self, examples: DataFrame) -> int:
        return _write_counted(examples.select(*EXAMPLES.fieldNames()), self.path)

    def reset(self) -> None:
        self.replace(self.spark.createDataFrame([], EXAMPLES))

    def read(self) -> DataFrame:
        return self.spark.read.schema(EXAMPLES).parquet(self.path)

    def count(self) -> int:
        return self.read().count()

    def sample(self, n: int = 5) -> DataFrame:
        return ordered_sample(self.read(), n)

    def export_jsonl(self, path: str) -> int:
        return files.write_jsonl(export_rows(self.read()), path)


def ordered_sample(examples: DataFrame, n: int = 5) -> DataFrame:
    return examples.orderBy("id").limit(n)


def export_rows(examples: DataFrame, by_id: bool = False) -> DataFrame:
    """Four of the five columns, by id; parsed_json stays JSON text. Examples that come
    `by_id` already are not sorted again."""
    rows = examples.select("id", "text", "parsed_json", "style")
    return rows if by_id else rows.orderBy("id")


@dataclass(frozen=True)
class DatasetFolder:
    """train/ and benchmark/ as JSON lines."""

    spark: SparkSession
    root: str

    @property
    def train_path(self) -> str:
        return f"{self.root}/train"

    @property
    def benchmark_path(self) -> str:
        return f"{self.root}/benchmark"

    def write(self, train: DataFrame, benchmark: DataFrame | None, force: bool = False) -> None:
        """Neither output is written while either one may not be, and both are whole before
        they take their places, so they may be made from what the folder holds. Without a
        new benchmark the stored one is left as it is."""
        outputs = [self.train_path] + ([] if benchmark is None else [self.benchmark_path])
        files.guard_outputs(self.spark, outputs, force)
        new = f"{self.root}/.new-{new_version()}"
        files.write_jsonl(train, f"{new}/train")
        if benchmark is not None:
            # Written as text: the numbers keep their canonical form.
            row = F.concat(
                F.lit('{"id": '), string_text(F.col("id")), F.lit(', "text": '),
                string_text(F.col("text")), F.lit(', "expected": '), lines_json("expected"),
                F.lit("}"),
            )
            benchmark.select(row.alias("value")).write.text(f"{new}/benchmark")
        for path in outputs:
            files.replace(self.spark, f"{new}/{path.rsplit('/', 1)[1]}", path)
        files.delete(self.spark, new)

    def train(self) -> DataFrame:
        return files.read_jsonl(self.spark, self.train_path, TRAIN)

    def benchmark(self) -> DataFrame:
        """The held-out rows; it is an error if there are none stored."""
        return files.read_jsonl(self.spark, self.benchmark_path, BENCHMARK)

    def fixed_benchmark(self) -> DataFrame | None:
        return self.benchmark() if files.exists(self.spark, self.benchmark_path) else None


@dataclass(frozen=True)
class ReviewStore:
    """data/<version>/ and the manifests in log/ that say which version is the queue."""

    spark: SparkSession
    path: str

    def _log(self) -> ManifestLog:
        return ManifestLog(self.spark, f"{self.path}/log")

    def reload(self, reviews: DataFrame) -> int:
        """Replace the whole queue; `reviews` may be read from this very store. A reload
        that ends early leaves the queue as it was."""
        version = new_version()
        typed = reviews.select(*[F.col(f.name).cast(f.dataType) for f in REVIEWS.fields])
        n = _write_counted(typed, f"{self.path}/data/{version}")
        self._log().publish(lambda _: {"version": version, "rows": n})
        return n

    def read(self) -> DataFrame:
        now = self._log().current()
        if now is None:
            return self.spark.createDataFrame([], REVIEWS)
        return self.spark.read.schema(REVIEWS).parquet(f"{self.path}/data/{now['version']}")

    def tidy(self) -> None:
        """Delete the versions that are not the queue; only while nobody reloads or reads."""
        now = self._log().current() or {}
        for name in files.child_names(self.spark, f"{self.path}/data"):
            if name != now.get("version"):
                files.delete(self.spark, f"{self.path}/data/{name}")


@dataclass(frozen=True)
class PredictionStore:
    """raw/run=<version>/ for audit, scored/run=<version>/ for the gate, manifests in log/
    that say which run holds each model's predictions, and promoted/<n>/ for the incumbent,
    outside of what the gate reads.

    The predictions of a run are evaluated once, into its raw copy; everything else is
    computed from what is stored. So raw and scored rows agree and a decision is about the
    rows that are kept, even if the model would answer otherwise the next time.
    """

    spark: SparkSession
    root: str

    def _log(self) -> ManifestLog:
        return ManifestLog(self.spark, f"{self.root}/log")

    def _save(self, rows: DataFrame, kind: str, run: str) -> None:
        schema = PREDICTIONS if kind == "scored" else PREDICTIONS_RAW
        kept = rows.select(*schema.fieldNames())
        with files.open_together(self.spark):
            kept.write.partitionBy("model_name", "version").parquet(f"{self.root}/{kind}/run={run}")

    def _run(self, kind: str, run: str) -> DataFrame:
        schema = PREDICTIONS if kind == "scored" else PREDICTIONS_RAW
        return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/run={run}")

    def record(self, raw: DataFrame) -> str:
        """Store a run's answers, score what was stored, and publish both; gives the run."""
        run = new_version()
        self._save(raw, "raw", run)
        self._save(scoring.score(self._run("raw", run)), "scored", run)
        return self._publish(run)

    def write(self, scored: DataFrame) -> str:
        """Store and publish a run that is scored already; gives the run."""
        run = new_version()
        self._save(scored, "scored", run)
        self._save(self._run("scored", run), "raw", run)
        return self._publish(run)

    def _publish(self, run: str) -> str:
        # One row for each model version of the run.
        held = self._run("scored", run).select("model_name", "version").distinct().collect()
        mine = {json.dumps([r["model_name"], r["version"]]): run for r in held}
        self._log().publish(lambda now: {"runs": {**now.get("runs", {}), **mine}})
        return run

    def _current(self, kind: str) -> DataFrame:
        schema = PREDICTIONS if kind == "scored" else PREDICTIONS_RAW
        runs = (self._log().current() or {}).get("runs", {})
        if not runs:
            return self.spark.createDataFrame([], schema)
        with_run = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
        base = f"{self.root}/{kind}"
        rows = (
            self.spark.read.schema(with_run).option("basePath", base)
            .parquet(*[f"{base}/run={run}" for run in sorted(set(runs.values()))])
        )
        current = F.lit(False)
        for key, run in sorted(runs.items()):
            model, version = json.loads(key)
            current = current | (
                (F.col("run") == run) & F.col("model_name").eqNullSafe(F.lit(model))
                & F.col("version").eqNullSafe(F.lit(version))
            )
        return rows.where(current).select(*schema.fieldNames())

    def scored(self, run: str | None = None) -> DataFrame:
        """The scored rows of a run, or of the last published run of each model version."""
        return self._current("scored") if run is None else self._run("scored", run)

    def raw(self, run: str | None = None) -> DataFrame:
        return self._current("raw") if run is None else self._run("raw", run)

    def tidy(self) -> None:
        """Delete runs that no manifest entry names any more, and those never published;
        only while no run is being written or read."""
        named = set((self._log().current() or {}).get("runs", {}).values())
        for kind in ("raw", "scored"):
            for name in files.child_names(self.spark, f"{self.root}/{kind}"):
                if name.removeprefix("run=") not in named:
                    files.delete(self.spark, f"{self.root}/{kind}/{name}")

    def snapshots(self) -> list[str]:
        base = f"{self.root}/promoted"
        return [
            n for n in files.child_names(self.spark, base)
            if files.exists(self.spark, f"{base}/{n}/_SUCCESS")
        ]

    def incumbent(self) -> DataFrame | None:
        """The latest complete snapshot."""
        done = self.snapshots()
        if not done:
            return None
        return self.spark.read.schema(PREDICTIONS).parquet(f"{self.root}/promoted/{done[-1]}")

    def promote(self, scored: DataFrame) -> str:
        """Keep `scored`, the stored rows of a run, as the next snapshot; earlier ones are
        never overwritten."""
        name = f"{len(files.child_names(self.spark, f'{self.root}/promoted')):06d}"
        path = f"{self.root}/promoted/{name}"
        scored.select(*PREDICTIONS.fieldNames()).write.mode("errorifexists").parquet(path)
        return path


#: Rows of the smaller table that a bucket is meant for, and buckets at least.
BUCKET_ROWS, LEAST_BUCKETS = 250_000, 8


def buckets_for(rows: int) -> int:
    """Buckets whose sort takes a task the same memory, however many rows there are."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


@dataclass(frozen=True)
class BucketedStore:
    """Rows stored in buckets of their id, as a table `name` whose files lie at `path`.

    Gold and predictions in equally many buckets are joined without a shuffle, however often
    they are scored.
    """

    spark: SparkSession
    name: str
    path: str
    buckets: int = 64

    def replace(self, rows: DataFrame) -> None:
        (
            rows.write.mode("overwrite").bucketBy(self.buckets, "id").sortBy("id")
            .option("path", self.path).saveAsTable(self.name)
        )

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The table; a session that does not know it yet is told of its `schema`."""
        if schema is not None and not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            where = self.path.replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {self.name} ({columns}) USING parquet "
                f"CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS LOCATION '{where}'"
            )
        return self.spark.table(self.name)
