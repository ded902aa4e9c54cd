"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. Of two fingerprints that differ in at
most two bits, one segment is equal (pigeonhole) and the next is at most two bits apart,
so they share a Golay index. Each fingerprint therefore gets, for each segment, the
segment itself with every index of the next one: 16 keys on average, of 33 or more bits.
Rows of one key are compared as a stream in sorted order.

A run of more than RUN fingerprints with one key is linked another exact way: two
fingerprints are at most two bits apart if and only if they share a word that is at most
one bit from both. So each is dealt to its 65 words, and a word gathers at most 65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm import golay
from ladewerk.llm.common import cut, partitions, small_batches, texts
from ladewerk.llm.components import components

SEED = 42
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # lowest bit, width
RUN = 64
#: The odd factor that mixes word hashes to shingle hashes.
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """The words, with A-Z in lower case; bytes.split() cuts at just the six ASCII spaces."""
    return text.encode().lower().split()


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """Joined runs of size words; all words if they are fewer, none if there are none."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    return [whole[a:b] for a, b in zip(begins.tolist(), ends[size - 1 :].tolist(), strict=True)]


def hashes(items: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x, SEED) for x in items), np.uint64, len(items))


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of size words; of all words if they are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    word = hashes(words)
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = (total ^ word[i : i + len(total)]) * FACTOR
        total ^= total >> np.uint64(29)
    return np.unique(total)


def majority(values: np.ndarray) -> int:
    """The bits set in over half of the 64-bit values, as a signed number; none give 0."""
    if not len(values):
        return 0
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(values)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and fingerprint (a signed 64-bit number) of each row's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [majority(hashes(shingles(words_of(t), size))) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.int64())], ["doc_id", "fingerprint"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint long")


def golay_keys(prints: np.ndarray, table: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The keys of signed fingerprints, and which fingerprint each belongs to."""
    values = prints.view(np.uint64)
    parts = [((values >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    keys, owner = [], []
    for s, exact in enumerate(parts):
        index, count = golay.indices(parts[(s + 1) % 3])
        use = np.arange(index.shape[1])[None, :] < count[:, None]
        base = (table * 3 + s) << 40 | exact << 12
        keys.append((base[:, None] | index)[use])
        owner.append(np.broadcast_to(np.arange(len(prints))[:, None], index.shape)[use])
    return np.concatenate(keys), np.concatenate(owner)


def _key_rows(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, value = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "fingerprint"))
            key, owner = golay_keys(value)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node[owner]), pa.array(value[owner])], ["key", "node", "fingerprint"])

    return nodes.mapInArrow(run, "key long, node long, fingerprint long")


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Rows sorted by key as (key, node, value, long): whole runs of at most most rows
    together, and pieces of longer runs, which are never held whole."""
    kept = [np.empty(0, np.int64)] * 3
    long_key = None
    for batch in batches:
        rows = [np.concatenate((k, batch.column(i).to_numpy(zero_copy_only=False))) for i, k in enumerate(kept)]
        if long_key is not None:
            same = int(np.searchsorted(rows[0], long_key, side="right"))
            if same:
                yield *[r[:same] for r in rows], True
            rows = [r[same:] for r in rows]
            if not len(rows[0]):
                kept = rows
                continue
            long_key = None
        if not len(rows[0]):
            continue
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        if len(rows[0]) - last > most:
            long_key = rows[0][-1]
            tail, kept = [r[last:] for r in rows], [r[:0] for r in rows]
        else:
            tail, kept = None, [r[last:] for r in rows]
        yield from _split([r[:last] for r in rows], most)
        if tail:
            yield *tail, True
    yield from _split(kept, most)


def _split(rows: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    if len(rows[0]):
        edges = np.flatnonzero(np.diff(rows[0], prepend=rows[0][0] - 1))
        size = np.repeat(np.diff(np.append(edges, len(rows[0]))), np.diff(np.append(edges, len(rows[0]))))
        for is_long in (False, True):
            own = (size > most) == is_long
            if own.any():
                yield *[r[own] for r in rows], is_long


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def links(nodes: DataFrame, bits: int = 2) -> DataFrame:
    """Edges (a, b) that connect all pairs of nodes (node, fingerprint; fingerprints
    distinct) at most two bits apart: every such pair, but for pairs that share a long
    run, where each pair is joined by a path of such pairs."""
    if bits != 2:
        raise ValueError("the keys are made for two differing bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, value, is_long in _runs(batches, RUN):
            if is_long:
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.nulls(len(node), pa.int64()), pa.array(value)], ["a", "b", "fingerprint"])
                continue
            for d in range(1, RUN):
                same = np.flatnonzero(key[d:] == key[:-d])
                if not len(same):
                    break
                same = same[_differing(value[same], value[same + d]) <= bits]
                if len(same):
                    yield pa.RecordBatch.from_arrays([pa.array(node[same]), pa.array(node[same + d]), pa.nulls(len(same), pa.int64())], ["a", "b", "fingerprint"])

    n = partitions(nodes)
    found = cut(_key_rows(nodes).repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long, fingerprint long"))
    words = F.concat(F.array("fingerprint"), *[F.array(F.col("fingerprint").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i))) for i in range(64)])
    dealt = found.where("b IS NULL").select(F.col("a").alias("node"), "fingerprint").distinct().select("node", F.explode(words).alias("word"))
    met = dealt.groupBy("word").agg(F.sort_array(F.collect_set("node")).alias("all")).where(F.size("all") > 1)
    rest = met.select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, 64)).alias("b"))
    return found.where("b IS NOT NULL").select("a", "b").unionByName(rest).distinct()


def simhash_components(docs: DataFrame, size: int = 3, bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each document.

    Documents are linked if their fingerprints differ in at most two bits; component_id is
    the smallest doc_id reachable. A null text is empty, and a text without words has
    fingerprint zero, which links like any other. Rows that repeat a doc_id each get a
    result; a null doc_id joins nothing and has a null component unless others share the
    fingerprint. An empty table gives no rows; other columns are not read.
    """
    prints = cut(fingerprints(docs, size))
    nodes = cut(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("node")))
    # Two fingerprints may share a doc_id if rows repeat one; the edges then join them.
    found = components(links(nodes.where("node IS NOT NULL"), bits))
    of = nodes.join(found, "node", "left").select("fingerprint", F.coalesce("component", "node").alias("component_id"))
    return prints.join(of, "fingerprint").select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
