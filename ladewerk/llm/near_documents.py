"""One document of each group of near-duplicates: SimHash first, then exactly.

Each document's set of word shingles has a SimHash fingerprint; fingerprints at most two
bits apart, which Golay keys find, name the pairs that are compared first. Whatever else is
near is found by the exact search of `minhash.near_groups`, which compares only what is not
connected yet. So the groups are those that all pairs of the asked similarity connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm import minhash, simhash
from ladewerk.llm.common import cut, lean_batches, small_batches, texts
from ladewerk.operators.joins import join_unique

_ROWS = "doc_id long, key binary, n long, digest binary, sketch array<long>, fingerprint long"


def _prints(docs: DataFrame, size: int) -> DataFrame:
    """The sketch of each row (see minhash.sketches) with the digest of its text as key and
    the SimHash of its set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [simhash.shingle_set(simhash.words_of(t), size) for t in texts(batch.column("text"))]
            signed = [np.sort(s.view(np.int64)) for s in sets]
            columns = [
                batch.column("doc_id"), batch.column("key"), pa.array(map(len, sets), pa.int64()),
                pa.array(map(minhash.set_digest, signed), pa.binary()),
                pa.array([s[: minhash.SKETCH] for s in signed], pa.list_(pa.int64())),
                pa.array(map(simhash.majority, sets), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ROWS.split(", ")])

    return small_batches(docs).mapInArrow(lean_batches(run), _ROWS)


def _keyed(docs: DataFrame) -> DataFrame:
    """docs as one struct column `row`, beside doc_id, text and key: their own columns may
    have any names."""
    body = F.coalesce(F.col("text"), F.lit(""))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(own, F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(body, 256)).alias("key"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without near-duplicates: of each group the document with the smallest doc_id stays.

    A group is what equal sets of `size`-word shingles (words lower-cased; all words, if they
    are fewer) and pairs of similarity or more (Jaccard) connect. A null text counts as
    empty, and texts without words are one group. Rows with the same doc_id and text are one
    document, of which one row stays; rows with the same doc_id and other texts, or with a
    null doc_id, are documents of their own. A null doc_id is the smallest; of equal doc_ids
    the text with the smallest digest leads. All columns are kept, whatever their names. An
    empty table gives no rows.

    The texts of documents that stay are not shuffled, but for a few that a bitmap of the
    removed ones mistakes: only what is removed, or stands in several rows, is joined.
    """
    named = _keyed(docs).select("row", "doc_id", "key")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("key"))
    rows = minhash.stored(_prints(read, size).withColumn("row", F.monotonically_increasing_id()), f"{minhash.new_folder(docs.sparkSession)}/prints")
    nodes = cut(rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node")))
    own = rows.select(F.col("row").alias("node"), "n", "digest", "sketch", "fingerprint")
    kept = minhash.merge_join(own, nodes.select("node"), "node", "left_semi")
    prints = cut(kept.groupBy("fingerprint").agg(F.min("node").alias("node")))
    near = simhash.links(prints)
    # Nodes of one fingerprint are met with its first.
    same = minhash.merge_join(kept.select("node", "fingerprint"), prints.select("fingerprint", F.col("node").alias("a")), "fingerprint").where("a <> node").select("a", F.col("node").alias("b"))
    pairs = near.unionByName(same).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = minhash.near_groups(docs, kept.drop("fingerprint"), size, similarity, pairs)
    # Documents without words are a group of their own, which no node names.
    group = minhash.merge_join(nodes, of, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    each = rows.groupBy("doc_id", "key", "digest").agg(F.count(F.lit(1)).alias("copies"))
    placed = minhash.merge_join(each, group, "digest", "left").withColumn("component", F.coalesce("component", F.lit(-1)))
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "key")).alias("first")
    top = placed.groupBy("component").agg(first).select("component", F.struct("first.doc_id", "first.key").alias("top"))
    judged = cut(minhash.merge_join(placed, top, "component").select("doc_id", "key", "copies", (F.struct("doc_id", "key") != F.col("top")).alias("gone")))
    # A null doc_id is joined as a value of its own.
    known = [F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", F.lit(0)).alias("id"), "key"]
    on = ["unknown", "id", "key"]
    gone, several = judged.where("gone").select(*known), judged.where("NOT gone AND copies > 1").select(*known)
    rest = join_unique(named.select("row", *known), gone, on, "left_anti", broadcast_bytes=0)
    alone = join_unique(rest, several, on, "left_anti", broadcast_bytes=0)
    one = rest.join(several.hint("merge"), on, "left_semi").groupBy(*on).agg(F.first("row").alias("row"))
    return alone.select("row.*").unionByName(one.select("row.*"))
