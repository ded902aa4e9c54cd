"""Session helpers: local sessions for tests, and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A task may hold this many times a core's even share of the rows, or so many rows.
UNEVEN, LEAST_ROWS = 1.25, 1_000
#: Rows of a task of a table that is dealt, so that what a task holds does not grow with it.
TASK_ROWS = 500_000


def local_session(cores: str = "8", memory: str = "8g", app: str = "ladewerk") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Where none is named, in local mode alone, each application gets one temporary folder,
    which is gone when Python ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="run-ladewerk-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDERS[app], ignore_errors=True)
    return _LOCAL_FOLDERS[app]


def spread(df: DataFrame) -> DataFrame:
    """Use every core for heavy row-local work on a table.

    What a scan task holds goes by bytes and row groups, so many tasks may be empty while a
    few hold all rows. The rows of each are counted, which reads no column. A table whose
    largest task holds little more than its share of a core is left alone; any other is
    dealt evenly.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.rdd.getNumPartitions()
    held = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    seen = held.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    n, most = seen["n"] or 0, seen["most"] or 0
    if tasks >= cores and most <= max(LEAST_ROWS, UNEVEN * n / cores):
        return df
    return df.repartition(max(cores, tasks, -(-n // TASK_ROWS)))


def in_order(df: DataFrame, key: Column) -> DataFrame:
    """df sorted by a key, for what is then computed row by row and stays in that order.

    A sort of rows with costly columns computes them twice, once only to see how the key is
    spread; so the rows are sorted before.
    """
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    return df.repartitionByRange(tasks, key).sortWithinPartitions(key)
