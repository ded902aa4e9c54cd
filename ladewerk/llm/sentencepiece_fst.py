"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three transducers are compiled from a model file: the normaliser (spaces become the space
mark, one mark is put in front), the pieces, and the byte fallback of characters that no
piece covers. An arc for a piece weighs nothing where the piece may follow the one before
it, and infinitely much elsewhere; a fallback arc weighs one. For a model of byte-pair
kind, a piece may follow another exactly if merging the two texts gives those two pieces
again; the tropical shortest path is then the one path of finite weight that uses pieces
wherever it can, and equals the merge result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm.common import small_batches, texts

MARK = "\u2581"
CACHED = 500_000


class Transducer:
    """Normaliser, pieces and byte fallback of one model, composed with each input."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.text: list[str | None] = []
        self.piece: dict[str, int] = {}
        self.byte = [0] * 256
        self.byte_of: dict[int, int] = {}
        self.score: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            self.text.append(None)
            if model.is_byte(i):
                self.byte[int(name[1:-1], 16)] = i
                self.byte_of[i] = int(name[1:-1], 16)
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                self.text[i] = name
                self.piece[name] = i
                self.score[name] = model.get_score(i)
        self.starts = {p[:i] for p in self.piece for i in range(1, len(p) + 1)}
        # No piece goes on over a space mark or holds a line end: paths meet in one state there.
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.piece):
            self.parts = re.compile(r"(?s).+")
        else:
            self.parts = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self.follows: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    def normalise(self, text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def merged(self, text: str) -> list[str]:
        """The pieces that merging adjacent ones leads to, the best score first and the
        leftmost among equal ones."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, a: int, b: int) -> bool:
        key = a, b
        found = self.follows.get(key)
        if found is None:
            x, y = self.text[a], self.text[b]
            found = self.follows[key] = self.merged(x + y) == [x, y]
        return found

    def shortest_path(self, part: str) -> list[int]:
        """Ids along the lightest path through a normalised part.

        Each position has one state of finite weight: the last piece of the path there
        (-1 at the start and after a fallback, which nothing merges with).
        """
        n = len(part)
        last, came = [-1] * (n + 1), [-1] * (n + 1)
        piece, follows, starts = self.piece.get, self.follows, self.starts
        for begin in range(n):
            # All arcs into begin are known: they come from earlier states.
            if came[begin] < 0:
                came[begin] = begin - 1
            before = last[begin]
            end = begin
            while end < n:
                end += 1
                text = part[begin:end]
                if text not in starts:
                    break
                if came[end] >= 0:  # a longer piece ends there
                    continue
                arc = piece(text)
                if arc is None:
                    continue
                if before >= 0:
                    fits = follows.get((before, arc))
                    if fits is None:
                        fits = self.may_follow(before, arc)
                    if not fits:
                        continue
                last[end], came[end] = arc, begin
        if came[n] < 0:
            came[n] = n - 1
        out: list[int] = []
        end = n
        while end:
            begin = came[end]
            if last[end] >= 0:
                out.append(last[end])
            else:
                out.extend(self.byte[b] for b in reversed(part[begin:end].encode()))
            end = begin
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """The ids, as little-endian unsigned 32-bit numbers."""
        out = []
        known = self.known
        for part in self.parts.findall(self.normalise(text)):
            ids = known.get(part)
            if ids is None:
                ids = np.array(self.shortest_path(part), "<u4").tobytes()
                if len(known) < CACHED and len(part) <= 32:
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces, runs of fallback bytes, then the normaliser inverted."""
        out = []
        text, byte_of = self.text, self.byte_of
        for i in np.frombuffer(ids, "<u4").tolist():
            p = text[i]
            out.append(p.encode() if p is not None else bytes((byte_of[i],)) if i in byte_of else b"")
        whole = b"".join(out).decode("utf-8", "replace").replace(MARK, " ")
        return whole[1:] if whole.startswith(" ") else whole


@cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of each text.

    path names a model file that every executor can open. A null text is empty and has no
    ids. Each row gets its result, repeated ones too; an empty table gives no rows; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([fst.encode(t) for t in texts(part.column("text"))], pa.binary())], ["doc_id", "ids"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_sha256 and same (decoding gives the text again; the
    space mark itself comes back as a space). Rows as in encode."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(path)
        for batch in batches:
            rows = []
            for d, t in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                ids = fst.encode(t)
                again = fst.decode(ids)
                rows.append((d, len(ids) // 4, zlib.crc32(ids), hashlib.sha256(again.encode()).hexdigest(), again == t))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "same"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, same boolean")
