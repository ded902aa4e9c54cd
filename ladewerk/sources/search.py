"""Text search that reads only the files in which every word can occur.

Beside the rows, each file has a bitmap of the hashed trigrams of its texts. A word can only
occur where all of its trigrams do, so the files that lack one are not opened; the rows of
the others are filtered as ever.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladewerk.functions.text import has_words
from ladewerk.sources import files
from ladewerk.sources.versions import ManifestLog, new_version

#: Places of a file's bitmap, and how many of them share a word of it.
PLACES, WORD = 1 << 18, 64
ROWS_PER_FILE = 100_000
#: Spark looks up each file that it is given by name, one by one: more than so many are read
#: by their folder, with the others left out when the files are chosen.
NAMED_FILES = 256


def trigram_places(rows: DataFrame, text: str, *keep: str) -> DataFrame:
    """keep and one row for each place of each text's trigrams."""
    lower = rows.select(*keep, F.lower(F.col(text)).alias("_t")).where(F.length("_t") > 2)
    # From each letter but the last two. A letter's number finds it in the split text at once.
    split = lower.select(*keep, F.split("_t", "").alias("_l"))
    at = split.select(*keep, "_l", F.explode(F.sequence(F.lit(0), F.size("_l") - 3)).alias("_i"))
    gram = F.concat(F.get("_l", "_i"), F.get("_l", F.col("_i") + 1), F.get("_l", F.col("_i") + 2))
    return at.select(*keep, F.pmod(F.xxhash64(gram), F.lit(PLACES)).alias("place"))


def blank_free(rows: DataFrame, text: str, *keep: str) -> DataFrame:
    """keep and the different parts between blanks and line ends of each text, in lower case.
    The words of a query hold neither, so no other trigram of the text is asked for."""
    flat = F.translate(F.lower(F.col(text)), "\n", " ")
    parts = rows.select(*keep, F.explode(F.array_distinct(F.split(flat, " "))).alias("part"))
    return parts.where(F.length("part") > 2)


@dataclass(frozen=True)
class SearchStore:
    """data/<version>/ with the rows, index/<version>/ with a bitmap for each file, and the
    manifests in log/ that say which version counts."""

    spark: SparkSession
    path: str
    text: str = "text"

    def _log(self) -> ManifestLog:
        return ManifestLog(self.spark, f"{self.path}/log")

    def replace(self, rows: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> None:
        """Store rows, index their texts, publish both."""
        version = new_version()
        data, index = (f"{self.path}/{part}/{version}" for part in ("data", "index"))
        rows.write.option("maxRecordsPerFile", rows_per_file).parquet(data)
        stored = self.spark.read.parquet(data).select(F.col("_metadata.file_path").alias("file"), F.col(self.text))
        # A task counts a word of a file once, by hash; a file has at most 4,096 words. The
        # file's name stands for all of its trigrams as one number; two files that should share
        # it would have each other's bits too, and be read for them.
        named = stored.select(F.xxhash64("file").alias("number"), "file").distinct()
        places = trigram_places(blank_free(stored.withColumn("number", F.xxhash64("file")), self.text, "number"), "part", "number")
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place", F.lit(WORD)).cast("int"))
        words = places.select("number", F.floor(F.col("place") / WORD).cast("int").alias("word"), one.alias("bit"))
        counted = words.groupBy("number", "word").agg(F.bit_or("bit").alias("bits"))
        counted.join(F.broadcast(named), "number").select("file", "word", "bits").write.parquet(index)
        self._log().publish(lambda _: {"version": version})

    def _version(self) -> str:
        now = self._log().current()
        if now is None:
            raise FileNotFoundError(f"nothing is stored at {self.path}")
        return now["version"]

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data/{self._version()}")

    def files_of(self, query: str) -> list[str]:
        """The files in which every word of the query can occur. Words of one or two
        letters are in no index; a query of such words alone reads all."""
        version = self._version()
        index = self.spark.read.parquet(f"{self.path}/index/{version}")
        words = self.spark.createDataFrame([(w,) for w in query.split()], "word string")
        wanted = sorted({r["place"] for r in trigram_places(words, "word").collect()})
        if not wanted:
            return [r["file"] for r in self.read().select(F.col("_metadata.file_path").alias("file")).distinct().collect()]
        held = F.lit(0)
        for place in wanted:
            held = held + F.when((F.col("word") == place // WORD) & (F.getbit("bits", F.lit(place % WORD)) == 1), 1).otherwise(0)
        asked = index.where(F.col("word").isin(sorted({place // WORD for place in wanted})))
        found = asked.groupBy("file").agg(F.sum(held).alias("held")).where(F.col("held") == len(wanted))
        # One name for each file that is read: Spark's driver lists them too.
        return sorted(r["file"] for r in found.select("file").collect())

    def search(self, query: str) -> DataFrame:
        """The rows whose text has every word of the query, in any case."""
        rows = self.read()
        names = self.files_of(query)
        if not names:
            return rows.where(F.lit(False))
        if len(names) > NAMED_FILES:
            chosen = rows.where(F.col("_metadata.file_path").isin(names))
        else:
            chosen = self.spark.read.schema(rows.schema).parquet(*names)
        return chosen.where(has_words(F.col(self.text), query))

    def tidy(self) -> None:
        """Delete versions that do not count any more; only while nobody writes or reads."""
        for part in ("data", "index"):
            for name in files.child_names(self.spark, f"{self.path}/{part}"):
                if name != self._version():
                    files.delete(self.spark, f"{self.path}/{part}/{name}")
