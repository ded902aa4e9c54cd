"""Packing token sequences by their length histogram.

Each document is cut into whole sequences and one rest. Only the histogram of lengths
goes to the driver, at most one row for each length. There the shortest-pack-first rule
places lengths, longest first, into patterns with counts; pieces find their place in the
patterns by their rank among the pieces of their length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladewerk.llm.common import cut, lean_batches, small_batches, texts

SEQUENCE = 1024
END_ID = 0
# --- fixed values: how a byte-level vocabulary splits text, and its bytes' characters ---
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# --- end of fixed values ---


def _is_plain(layout: dict) -> bool:
    """Whether a tokenizer file is a byte-level BPE that numbers its tokens in the order of
    the merges, with special tokens that are matched as they stand."""
    model, before = layout["model"], layout["pre_tokenizer"] or {}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model.get("merges", [])]
    ids = [model["vocab"][m] for m in merged] if model["type"] == "BPE" else []
    return (
        len(ids) > 0 and ids == list(range(ids[0], ids[0] + len(ids))) and ids[0] >= 256
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        and layout["normalizer"] is None and layout["truncation"] is None and layout["padding"] is None
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in layout["added_tokens"])
    )


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _encoder(path: str) -> Callable[[str], np.ndarray]:
    """A function that gives a text's ids as the tokenizers library does with this file.

    Plain byte-level files are read into tiktoken, which gives the same ids at a third of
    the cost; any other file, and a text that it gives up on, is left to tokenizers, which
    is loaded only then: a worker keeps what it has loaded.
    """
    with open(path, encoding="utf-8") as f:
        layout = json.load(f)

    def whole(text: str) -> np.ndarray:
        return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4")

    if not _is_plain(layout):
        return whole
    import tiktoken

    special = {t["content"]: t["id"] for t in layout["added_tokens"]}
    hidden = [b for b in range(256) if b not in SHOWN_BYTES]
    byte_of = {chr(b): b for b in SHOWN_BYTES} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in layout["model"]["vocab"].items() if t not in special}
    encoding = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        try:
            return encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its pattern gives up on white space of about a million characters
            return whole(text)

    return encode


def token_ids(bodies: list[str], path: str) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit numbers."""
    encode = _encoder(path)
    return [encode(t).astype("<u4").tobytes() for t in bodies]


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: documents cut at multiples of sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for d, ids in zip(part.column("doc_id").to_pylist(), token_ids(texts(part.column("text")), path), strict=True):
                    ids += END_ID.to_bytes(4, "little")
                    n = len(ids) // 4
                    rows += [(d, s, min(sequence, n - s), zlib.crc32(ids[4 * s : 4 * (s + sequence)]), n) for s in range(0, n, sequence)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(lean_batches(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def patterns(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) with how many sequences take each.

    Lengths are placed longest first, each into the shortest open pack if it fits there,
    else into new packs; packs that are alike are kept as one pattern with a count.
    """
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            total = min(open_, default=sequence)
            if total + length > sequence:
                open_.setdefault(length, []).append(((length,), left))
                break
            pattern, count = open_[total].pop()
            n = min(left, count)
            if n < count:
                open_[total].append((pattern, count - n))
            if not open_[total]:
                del open_[total]
            open_.setdefault(total + length, []).append(((*pattern, length), n))
            left -= n
    return sorted((p for packs in open_.values() for p in packs), reverse=True)


def ranked(rows: DataFrame) -> DataFrame:
    """rows with rank, from 0, among those of their length; rows must be a table that is
    read the same way each time. No length meets in one task: ranks are given inside each
    partition and moved up by what earlier partitions hold."""
    parts = rows.withColumn("part", F.spark_partition_id())
    held = parts.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = held.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    inside = parts.withColumn("inside", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")) - 1)
    return inside.join(before, ["length", "part"]).withColumn("rank", F.col("inside") + F.col("before")).drop("inside", "before", "part")


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    path names a tokenizer file that every executor can open. A null or empty text is one
    piece of the end id alone. Rows that repeat a document are packed once each; an empty
    table gives no rows; other columns are not read.
    """
    found = cut(pieces(docs, path, sequence))
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int]]] = {}  # length: first rank, first sequence, offset
    used: dict[int, int] = {}
    first = 0
    for lengths, count in patterns(histogram, sequence):
        offset = 0
        for n in lengths:
            rank = used.get(n, 0)
            slots.setdefault(n, []).append((rank, first, offset))
            used[n] = rank + count
            offset += n
        first += count
    table = {n: np.array(x, np.int64) for n, x in slots.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            out = np.empty((2, len(length)), np.int64)
            for n in np.unique(length).tolist():
                own = np.flatnonzero(length == n)
                slot = table[n][np.searchsorted(table[n][:, 0], rank[own], side="right") - 1]
                out[0, own] = slot[:, 1] + rank[own] - slot[:, 0]
                out[1, own] = slot[:, 2]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out[0]), pa.array(out[1])], [*names, "sequence_id", "offset"])

    return ranked(found).mapInArrow(lean_batches(place), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
