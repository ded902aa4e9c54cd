"""Exact removal of long byte strings that also start earlier in the corpus.

Only windows whose anchor (the smallest hash of a short string inside the window, the
leftmost on ties) occurs again can repeat, and equal windows have equal anchors. So
anchors are counted over all texts, the stretches around repeated ones are dealt out by
anchor, and there the Burrows-Wheeler transforms of shards of stretches are merged; the
blocks of the merge that share the whole length are the repeated strings.

Texts are dealt once into blocks by doc_id; the three passes over them read that same
exchange. What comes back to a block are packed places. Equal stretches of one block
are sent once, so a passage in a third of all rows sends one stretch a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladewerk.llm import bwt
from ladewerk.llm.common import blobs, joined, lean, small_batches

GRAM = 24
CHUNK_BYTES = 1 << 20
#: Bytes of text for each block of texts and each bucket of anchors.
BLOCK_BYTES = 4 << 20
POSITION_BITS = 24


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For texts laid one after another (their ends given): each anchor's hash, the first
    window start that it stands for, how many starts in a row, and its distance from the
    first."""
    n, width = len(data), length - GRAM + 1
    none = np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3
    if n < length:
        return none
    eight = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).copy()
    eight *= np.uint64(0x9E3779B97F4A7C15)
    eight ^= eight >> np.uint64(32)
    grams = eight[:-16] * np.uint64(0xC2B2AE3D27D4EB4F)
    grams += eight[8:-8]
    grams *= np.uint64(0x165667B19E3779F9)
    grams += eight[16:]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    mask = np.uint64((1 << POSITION_BITS) - 1)
    least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    valid = np.ones(len(least), bool)
    for end in ends[:-1].tolist():
        valid[max(0, end - length + 1) : end] = False
    starts = np.flatnonzero(valid)
    if not len(starts):
        return none
    place = (least[starts] & mask).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return grams[place[new]], starts[new], np.diff(np.append(new, len(starts))), place[new] - starts[new]


def _documents(left: pa.Table) -> list[tuple[bool, int, bytes]]:
    """The distinct (id, text) of a block in their fixed order; a null id comes first."""
    ids = left.column("id").to_pylist()
    return sorted(set(zip([x is not None for x in ids], [x or 0 for x in ids], blobs(left.column("body")), strict=True)))


def _chunks(docs: list[tuple[bool, int, bytes]], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """hash, document number, start in it, number of starts and own distance of all anchors, chunk by
    chunk of documents; a longer document is cut into chunks that overlap."""
    number, parts, size = [], [], 0

    def flush():
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        h, start, count, far = anchors(data, ends, length)
        which = np.searchsorted(ends, start, side="right")
        first = ends - [len(p) for p in parts]
        base = np.array([b for _, b in number])
        return h, np.array([i for i, _ in number])[which], start - first[which] + base[which], count, far

    for i, (_, _, body) in enumerate(docs):
        for base in range(0, max(1, len(body) - length + 1), CHUNK_BYTES):
            piece = body[base : base + CHUNK_BYTES + length - 1]
            if len(piece) < length:
                continue
            if size and size + len(piece) > CHUNK_BYTES:
                yield flush()
                number, parts, size = [], [], 0
            number.append((i, base))
            parts.append(piece)
            size += len(piece)
    if parts:
        yield flush()


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that lays equal buckets side by side, and (bucket, from, to)."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = bwt.stable_order(bucket)
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    return order, [(int(bucket[order[a]]), int(a), int(b)) for a, b in zip(cut[:-1], cut[1:], strict=True)] if len(order) else []


def suffix_repeats(docs: DataFrame, length: int = 100, carry: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents (doc_id, text) without the bytes that an earlier string of length covers.

    docs: doc_id and text, and the columns named in carry; others are not read. One row
    for each distinct document row: doc_id, carry, n_bytes, n_removed, n_spans (maximal
    removed runs) and kept (the remaining bytes). Earlier is a smaller doc_id (null comes
    first; rows of one doc_id by their text), or an earlier start in the same document.
    A null text is empty; a repeated row (same id and text) counts as one document, each
    row getting its result. Texts shorter than length lose nothing. An empty table gives
    no rows. A task holds one block or bucket at a time, each of about block_bytes of text
    or one longer text.
    """
    if length % bwt.STEP or length < 2 * GRAM:
        raise ValueError(f"length must be a multiple of {bwt.STEP} and at least {2 * GRAM}")
    size = small_batches(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = buckets = 1 + size // block_bytes
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"),
        *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)],
    )

    def hashes(left: pa.Table) -> pa.Table:
        block = left.column("block")[0].as_py()
        found = joined([c[0] for c in _chunks(_documents(left), length)], np.uint64)
        keys, counts = np.unique(found, return_counts=True)
        order, runs = _by_bucket(keys, buckets)
        keys, many = keys[order], (counts[order] > 1).astype(np.uint8)
        return pa.table({
            "bucket": pa.array([r[0] for r in runs], pa.int32()),
            "block": pa.array([block] * len(runs), pa.int32()),
            "keys": pa.array([keys[a:b].tobytes() for _, a, b in runs], pa.binary()),
            "many": pa.array([many[a:b].tobytes() for _, a, b in runs], pa.binary()),
        })

    def repeated(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()]
        many = np.frombuffer(b"".join(group.column("many").to_pylist()), np.uint8)
        keys, which, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        keep = counts[which] > 1
        keep |= np.bincount(which, weights=many)[which] > 0
        ends = np.cumsum([len(p) for p in parts])
        out = [p[keep[e - len(p) : e]].tobytes() for p, e in zip(parts, ends.tolist(), strict=True)]
        rows = [(b, x) for b, x in zip(group.column("block").to_pylist(), out, strict=True) if x]
        return pa.table({"block": pa.array([b for b, _ in rows], pa.int32()), "keys": pa.array([x for _, x in rows], pa.binary())})

    stretch_type = "bucket int, block int, sent binary, lengths binary, starts binary, far binary, ids binary, known binary, doc binary, start binary"

    def stretches(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({f: pa.array([], pa.int32() if f in ("bucket", "block") else pa.binary()) for f in [x.split()[0] for x in stretch_type.split(", ")]})
        if not left.num_rows or not right.num_rows:
            return empty
        block = left.column("block")[0].as_py()
        wanted = np.unique(np.frombuffer(b"".join(right.column("keys").to_pylist()), np.uint64))
        docs_ = _documents(left)
        seen: dict[bytes, None] = {}
        rows = []  # hash, id known, id, document, start, count, distance of the anchor
        again = []
        for h, doc, start, count, far in _chunks(docs_, length):
            at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            hit = wanted[at] == h
            for key, i, s, c, f in zip(h[hit].tolist(), doc[hit].tolist(), start[hit].tolist(), count[hit].tolist(), far[hit].tolist(), strict=True):
                known, number, body = docs_[i]
                piece = body[s : s + c + length - 1]
                if piece in seen:
                    again.append((i, s, c))
                else:
                    seen[piece] = None
                    rows.append((key, known, number, i, s, c, f))
        pieces = list(seen)
        keys = np.array([r[0] for r in rows], np.uint64)
        order, runs = _by_bucket(keys, buckets)
        cols = {k: np.array([r[j] for r in rows], t)[order] for k, j, t in (("known", 1, np.uint8), ("ids", 2, np.int64), ("doc", 3, np.int32), ("start", 4, np.int64), ("starts", 5, np.uint8), ("far", 6, np.uint8))}
        pieces = [pieces[i] for i in order.tolist()]
        lengths = np.array([len(p) for p in pieces], np.int32)
        out = {
            "bucket": [r[0] for r in runs], "block": [block] * len(runs),
            "sent": [b"".join(pieces[a:b]) for _, a, b in runs], "lengths": [lengths[a:b].tobytes() for _, a, b in runs],
            **{k: [v[a:b].tobytes() for _, a, b in runs] for k, v in cols.items()},
        }
        if again:  # later ones of equal stretches: nothing is left to find out
            out["bucket"].append(block % buckets)
            out["block"].append(block)
            for name in ("sent", "lengths", "far", "ids", "known"):
                out[name].append(b"")
            for name, j, t in (("doc", 0, np.int32), ("start", 1, np.int64), ("starts", 2, np.uint8)):
                out[name].append(np.array([x[j] for x in again], t).tobytes())
        return pa.table({f: pa.array(out[f], pa.int32() if f in ("bucket", "block") else pa.binary()) for f in empty.column_names})

    def merged(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        out_block = [r["block"] for r in rows if not r["sent"]]
        out_place = [_places(np.frombuffer(r["doc"], np.int32), np.frombuffer(r["start"], np.int64), np.frombuffer(r["starts"], np.uint8)) for r in rows if not r["sent"]]
        rows = [r for r in rows if r["sent"]]
        if rows:
            cat = lambda k, t: np.frombuffer(b"".join(r[k] for r in rows), t)
            lengths, starts, doc, start = cat("lengths", np.int32), cat("starts", np.uint8).astype(np.int64), cat("doc", np.int32), cat("start", np.int64)
            block = np.repeat([r["block"] for r in rows], [len(r["lengths"]) // 4 for r in rows])
            where = np.lexsort((start, doc, block, cat("ids", np.int64), cat("known", np.uint8)))
            turn = np.empty(len(where), np.int64)
            turn[where] = np.arange(len(where))
            ends = np.cumsum(lengths)
            data = b"".join(r["sent"] for r in rows)
            first: dict[bytes, int] = {}
            for i in where.tolist():
                first.setdefault(data[ends[i] - lengths[i] : ends[i]], i)
            lead = np.fromiter(first.values(), np.int64, len(first))
            found = _repeats(list(first), cat("far", np.uint8)[lead], starts[lead], turn[lead] << 8, length)
            is_lead = np.zeros(len(turn), bool)
            is_lead[lead] = True
            # Of a leading stretch those starts that repeat, of the others all.
            bases = np.cumsum(starts[lead]) - starts[lead]
            edge = np.concatenate(([False], found[:-1]))
            edge[bases] = False
            begin = np.flatnonzero(found & ~edge)
            stop = np.concatenate((found[1:], [False]))
            stop[(bases - 1)[1:]] = False
            finish = np.flatnonzero(found & ~stop)
            owner = np.searchsorted(bases, begin, side="right") - 1
            rest = np.flatnonzero(~is_lead)
            block_all = np.concatenate((block[lead][owner], block[rest]))
            doc_all = np.concatenate((doc[lead][owner], doc[rest]))
            start_all = np.concatenate((start[lead][owner] + begin - bases[owner], start[rest]))
            count_all = np.concatenate((finish - begin + 1, starts[rest]))
            order = np.argsort(block_all, kind="stable")
            cuts = np.flatnonzero(np.diff(block_all[order], prepend=-1, append=-1))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = order[a:b]
                out_block.append(int(block_all[own[0]]))
                out_place.append(_places(doc_all[own], start_all[own], count_all[own]))
        return pa.table({"block": pa.array(out_block, pa.int32()), "places": pa.array(out_place, pa.binary())})

    carried = [f for f in dealt.schema.fields if f.name.startswith("carry_")]

    def removed(left: pa.Table, right: pa.Table) -> pa.Table:
        docs_ = _documents(left) if left.num_rows else []
        places = np.frombuffer(b"".join(right.column("places").to_pylist()) if right.num_rows else b"", np.int64).reshape(-1, 3)
        places = places[np.lexsort((places[:, 1], places[:, 0]))]
        edges = np.searchsorted(places[:, 0], np.arange(len(docs_) + 1))
        done = {}
        for i, key in enumerate(docs_):
            own = places[edges[i] : edges[i + 1]]
            done[key] = _without(key[2], own[:, 1], own[:, 1] + own[:, 2] + length - 1)
        ids = left.column("id").to_pylist()
        rows = [done[(x is not None, x or 0, body)] for x, body in zip(ids, blobs(left.column("body")), strict=True)]
        return pa.table({
            "id": left.column("id"), **{f.name: left.column(f.name) for f in carried},
            "n_bytes": pa.array([r[0] for r in rows], pa.int64()), "n_removed": pa.array([r[1] for r in rows], pa.int64()),
            "n_spans": pa.array([r[2] for r in rows], pa.int64()), "kept": pa.array([r[3] for r in rows], pa.binary()),
        })

    grouped = dealt.groupBy("block")
    twice = grouped.applyInArrow(lambda left: lean(hashes, left), "bucket int, block int, keys binary, many binary").groupBy("bucket").applyInArrow(lambda group: lean(repeated, group), "block int, keys binary")
    sent = grouped.cogroup(twice.groupBy("block")).applyInArrow(lambda left, right: lean(stretches, left, right), stretch_type)
    places = sent.groupBy("bucket").applyInArrow(lambda group: lean(merged, group), "block int, places binary")
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in carried)
    out = grouped.cogroup(places.groupBy("block")).applyInArrow(lambda left, right: lean(removed, left, right), f"id long, {kinds}n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.col("id").alias("doc_id"), *[F.col(f.name).alias(c) for f, c in zip(carried, carry, strict=True)], "n_bytes", "n_removed", "n_spans", "kept")


def _repeats(pieces: list[bytes], far: np.ndarray, starts: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    """bwt.repeats of those stretches that can share a window with another one.

    A window reaches half of its rest beyond its anchor, to the left or to the right. So
    stretches that share a window share the anchor with that much on one side."""
    side = (length - GRAM) // 2
    shared: dict[bytes, int] = {}
    keys = []
    for p, f in zip(pieces, far.tolist(), strict=True):
        both = (b"<" + p[f - side : f + GRAM] if f >= side else b"", b">" + p[f : f + GRAM + side] if f + GRAM + side <= len(p) else b"")
        keys.append(both)
        for k in both:
            shared[k] = shared.get(k, 0) + 1
    shared[b""] = 0
    some = np.array([shared[a] > 1 or shared[b] > 1 for a, b in keys], bool)
    found = np.zeros(int(starts.sum()), bool)
    if some.any():
        own = np.flatnonzero(some)
        found[np.repeat(some, starts)] = bwt.repeats([pieces[i] for i in own.tolist()], starts[own], position[own], length)
    return found


def _places(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> bytes:
    return np.stack((doc.astype(np.int64), start.astype(np.int64), count.astype(np.int64)), axis=1).tobytes()


def _without(body: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[int, int, int, bytes]:
    """Length, bytes removed, runs removed and the rest; begin ascends."""
    kept, at, gone, spans = [], 0, 0, 0
    edge = -1
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        if a > edge:  # runs that touch are one
            spans += 1
            kept.append(body[at:a])
            at = edge = b
            gone += b - a
        elif b > edge:
            gone += b - edge
            at = edge = b
    kept.append(body[at:])
    return len(body), gone, spans, b"".join(kept)


def kept_text(column: str) -> Column:
    """The remaining bytes as a text; what a removed run leaves of a character goes too."""

    @F.pandas_udf("string")
    def decode(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    return decode(column)
