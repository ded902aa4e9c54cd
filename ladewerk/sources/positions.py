"""Line numbers of text files, without a sort and without one task that counts.

Spark cuts files into splits, and a task reads the lines of a split in their order. So two
passes number every line: one counts the lines of each split, whose running sums on the
driver say where each split starts; the other counts inside the splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One row a split goes to the driver and is sent to all tasks. Spark's driver lists every
#: split too; a split has up to 128 MB, so this many are about 100 TB.
BROADCAST_SPLITS = 1_000_000
#: Lines that a Python worker holds at once at most: a line may be a long text.
BATCH_LINES = 512
_SPLIT = ["file", "split", "length"]
_NUMBERED = "file string, split long, length long, line_no long, row_idx long, line string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line with its file and the split of the file that it starts in."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_block_length").alias("length"),
        F.col("value").alias("line"),
    )


def _written(line: str) -> Column:
    return F.regexp_like(F.col(line), F.lit(r"\S"))


def _starts(counts: list) -> list[tuple]:
    """(file, split, length, lines before it in its file, written lines before it in all
    files), files by name."""
    out, rows, lines, at = [], 0, 0, None
    for c in sorted(counts, key=lambda c: (c["file"], c["split"])):
        if c["file"] != at:
            at, lines = c["file"], 0
        out.append((c["file"], c["split"], c["length"], lines, rows))
        lines += c["lines"]
        rows += c["rows"]
    return out


def _count_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the lines of each split, and its written lines, from 0."""
    at, lines, rows = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        files, splits = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        names, codes = files.dictionary.to_pylist(), files.indices.to_numpy()
        written = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(splits, prepend=splits[0]) != 0))
        line_no, row_idx = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
        for a, b in zip(edges, [*edges[1:], len(codes)], strict=True):
            here = (names[codes[a]], splits[a])
            if here != at:
                at, lines, rows = here, 0, 0
            line_no[a:b] = np.arange(lines, lines + b - a)
            row_idx[a:b] = rows + np.cumsum(written[a:b]) - written[a:b]
            lines, rows = lines + int(b - a), rows + int(written[a:b].sum())
        columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(line_no), pa.array(row_idx), batch.column(3)]
        out = pa.RecordBatch.from_arrays(columns, ["file", "split", "length", "line_no", "row_idx", "line"])
        yield out.filter(pa.array(written.astype(bool)))


def numbered_lines(spark: SparkSession, path: str, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """file, line_no, row_idx and line of each line that is not blank.

    line_no counts all lines of the file from 1; row_idx counts the lines that are not
    blank from 0 over all files of the path, in the order of their names. Should a later
    read cut the files into other splits than were counted, it fails rather than misnumber.
    """
    lines = _lines(spark, path)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_LINES:
        # For the rest of the session, as the lines are read when the result is used.
        spark.conf.set(key, str(BATCH_LINES))
    counts = lines.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("lines"), F.count_if(_written("line")).alias("rows")).collect()
    starts = spark.createDataFrame(_starts(counts), "file string, split long, length long, lines_before long, rows_before long")
    inside = lines.select(*_SPLIT, "line", _written("line").alias("written")).mapInArrow(_count_inside, _NUMBERED)
    side = F.broadcast(starts) if len(counts) <= broadcast_splits else starts.hint("merge")
    moved = F.raise_error(F.concat(F.lit("the splits of a file changed while it was numbered: "), F.col("file")))

    def before(name: str) -> Column:
        return F.when(F.col(name).isNull(), moved.cast("long")).otherwise(F.col(name))

    return inside.join(side, _SPLIT, "left").select(
        "file", (before("lines_before") + F.col("line_no") + 1).alias("line_no"),
        (before("rows_before") + F.col("row_idx")).alias("row_idx"), "line",
    )
