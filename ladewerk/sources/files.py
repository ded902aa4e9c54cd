"""Paths, and JSON-lines tables with an explicit schema."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladewerk.functions.binding import computed
from ladewerk.functions.validation import PLAIN_LINES, lines_of_variant, whole_value
from ladewerk.schema import SEED
from ladewerk.sources.positions import numbered_lines


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop_path(spark, path)
    return fs.exists(jpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath))


def create_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a short text to a file that must not be there yet."""
    fs, jpath = _hadoop_path(spark, path)
    out = fs.create(jpath, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a short file."""
    fs, jpath = _hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop_path(spark, path)
    fs.delete(jpath, True)


def replace(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished file or folder in the place of what is at `path`."""
    delete(spark, path)
    fs, jnew = _hadoop_path(spark, new)
    if not fs.rename(jnew, _hadoop_path(spark, path)[1]):
        raise OSError(f"{new} could not be moved to {path}")


def guard_outputs(spark: SparkSession, paths: Iterable[str], force: bool = False) -> None:
    """Raise if any output is there already; called before the first is written."""
    if force:
        return
    for path in paths:
        if exists(spark, path):
            raise FileExistsError(f"{path} already exists; pass force=True to overwrite.")


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False
) -> DataFrame:
    """Rows of a JSON-lines file, folder or glob. Blank lines are skipped, a broken
    line fails the job, and a missing path is an empty table only if allowed."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def broken_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """file, line_no and line of each line that is not a JSON object of the schema."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json("line", with_bad, {"mode": "PERMISSIVE"})
    bad = parsed.getField("_corrupt_record").isNotNull()
    return numbered_lines(spark, path).where(bad).select("file", "line_no", "line")


_PLAIN_TEXT = r'"(?:[ !#-\[\]-~]++|\\["\\/bfnrt])*+"'
_PLAIN_SEED = rf'\A\{{"id": {_PLAIN_TEXT}, "text": {_PLAIN_TEXT}, "gold": {PLAIN_LINES}\}}\z'


def checked_seed(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, row_idx, id, text, gold and problem of each line that is not blank;
    problem is null where the line is one JSON object with a text and sound gold lines."""
    # A line that is all in order, as one regular expression tells, is read in one pass.
    line = F.col("line")
    said = computed(
        numbered_lines(spark, path).withColumn("_plain", line.rlike(_PLAIN_SEED)),
        F.when(F.col("_plain"), F.from_json("line", SEED)).alias("_s"),
        F.when(~F.col("_plain"), whole_value("line")).alias("_v"),
    )
    plain, given = F.col("_plain"), F.col("_s")
    read = computed(
        said.drop("line"),
        F.when(plain, given.getField("id")).otherwise(F.try_variant_get("_v", "$.id", "string")).alias("id"),
        F.when(plain, given.getField("text")).otherwise(F.try_variant_get("_v", "$.text", "string")).alias("text"),
        F.when(plain, given.getField("gold")).otherwise(lines_of_variant(F.try_variant_get("_v", "$.gold", "variant"))).alias("gold"),
    )
    problem = (
        F.when(plain, None)
        .when(F.col("_v").isNull(), "invalid JSON")
        .when(F.try_variant_get("_v", "$", "map<string,variant>").isNull(), "not an object")
        .when(F.col("text").isNull(), "no text")
        .when(F.col("gold").isNull(), "no sound gold lines")
    )
    return read.select("file", "line_no", "row_idx", "id", "text", "gold", problem.alias("problem"))


def seed_problems(checked: DataFrame) -> DataFrame:
    """Where each line of `checked_seed` that cannot be used stands, and why."""
    place = F.concat_ws(":", "file", "line_no").alias("place")
    return checked.where(F.col("problem").isNotNull()).select(place, "file", "line_no", "problem")


def read_seed(spark: SparkSession, path: str, keep_at: str) -> DataFrame:
    """row_idx, id, text, gold of a seed file, folder or glob.

    The lines are parsed once and kept at `keep_at`. A broken line is an error that names
    the first one as file:line, and so is an empty file, since nothing could be reviewed.
    """
    checked_seed(spark, path).write.parquet(keep_at)
    kept = spark.read.parquet(keep_at)
    bad = F.col("problem").isNotNull()
    seen = kept.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_bad"),
        F.min(F.when(bad, F.struct("file", "line_no", "problem"))).alias("first"),
    ).first()
    if seen["n_bad"]:
        first, more = seen["first"], seen["n_bad"] - 1
        raise ValueError(f"{first['file']}:{first['line_no']}: {first['problem']}" + (f" (and {more} more lines)" if more else ""))
    if not seen["n"]:
        raise ValueError(f"seed file is empty: {path}")
    return kept.select("row_idx", "id", "text", "gold")


def write_jsonl(df: DataFrame, path: str, force: bool = True) -> int:
    """Write and count in one pass."""
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("n"))
    watched.write.mode("overwrite" if force else "errorifexists").json(path)
    return seen.get["n"]


@contextmanager
def open_together(spark: SparkSession, writers: int = 8) -> Iterator[None]:
    """Tables written within in a folder for each of a few values: a task keeps that many
    files open, so its rows are not sorted by folder first. With more values it sorts."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(writers))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_gate_files(scored: DataFrame, folder: str) -> None:
    """Scored predictions as JSON lines, `<model>.jsonl` for each model, in one pass; each
    is a folder of part files, so a model may have any number of rows. They are compressed,
    as the lines of a list repeat all field names."""
    spark = scored.sparkSession
    named = scored.withColumn("_file", F.col("model_name"))
    with open_together(spark):
        named.write.partitionBy("_file").option("compression", "gzip").json(f"{folder}/.new")
    for name in child_names(spark, f"{folder}/.new"):
        if name.startswith("_file="):
            replace(spark, f"{folder}/.new/{name}", f"{folder}/{name.removeprefix('_file=')}.jsonl")
    delete(spark, f"{folder}/.new")


def read_gate_files(spark: SparkSession, glob: str, schema: T.StructType) -> DataFrame:
    """The gate's scalar columns of scored JSON-lines files, one file (or folder of part
    files) per model; the glob is not recursive. `file_model` is the model as the file is
    named."""
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+)\.jsonl?(?:/part-[^/]*)?$", 1)
    return spark.read.schema(schema).json(glob).withColumn("file_model", stem)
