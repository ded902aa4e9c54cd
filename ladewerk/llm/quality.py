"""Quality rules: fixed base rules, and a hashed n-gram likelihood ratio.

Two multinomials over hashed byte n-grams are counted: of trusted documents (the target)
and of the whole corpus (raw). A document's score is the mean log-likelihood ratio of its
n-grams; a document under the threshold is rejected. Nothing is drawn at random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm.common import lean_batches, small_batches, texts
from ladewerk.operators.joins import partnered

ORDERS = (3, 5)
BUCKET_BITS = 16
SHARES = 64
#: Words of the bitmap of trusted ids, and how many tasks the rows of one id are dealt to.
BITMAP_WORDS, SALTS = 1 << 20, 16
#: Raw counts get one more for each bucket; the target is drawn to the raw distribution as
#: by this many n-grams, so that a small trusted set tells little.
SMOOTHING, PRIOR = 1.0, float(1 << BUCKET_BITS)
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Mean log ratio (nats for each n-gram) under which a document is rejected.
THRESHOLD = -0.25
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    body = text.encode()
    words = body.split()
    spaces = len(body) - len(body.translate(None, SPACES))
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    again = 0
    for line in body.split(b"\n"):
        if line and not line.isspace():
            again += line in seen
            seen.add(line)
    return len(words), len(text) - spaces, symbols, again, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a run of WINDOW words found at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    value = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    runs = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + value[i : i + n]
        runs ^= runs >> np.uint64(29)
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(hit), 1)
    np.add.at(cover, np.flatnonzero(hit) + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def grams(body: bytes) -> list[np.ndarray]:
    """The bucket of every byte n-gram, one array for each order."""
    padded = np.frombuffer(body + bytes(8), np.uint8)
    out = []
    for order in ORDERS:
        n = max(0, len(body) - order + 1)
        value = np.ndarray((n,), "<u8", padded, strides=(1,)).copy()
        value &= np.uint64((1 << 8 * order) - 1)
        value *= np.uint64(0x9E3779B97F4A7C15)
        out.append((value >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return out


def ngram_counts(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """Counts of all n-gram buckets: [target, raw] x order x bucket.

    docs: doc_id, text. trusted: distinct doc_ids, of any number. The raw counts are taken
    where the texts are read. For the target's, a bitmap of the trusted ids says which texts
    may be trusted; only those are dealt out and joined with the ids, salted, as one id may
    stand in many rows. Each task sends one row of counts for each share of the buckets.
    """
    size = len(ORDERS) << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for text in texts(batch.column("text")):
                for i, g in enumerate(grams(text.encode())):
                    part = total[i << BUCKET_BITS : (i + 1) << BUCKET_BITS]
                    if len(g) >= 4096:
                        part += np.bincount(g, minlength=1 << BUCKET_BITS)
                    else:
                        np.add.at(part, g, 1)
        shares = total.reshape(SHARES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(SHARES), pa.int32()), pa.array([s.tobytes() for s in shares], pa.binary())], ["share", "counts"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for x in batch.column("counts"):
                total = total + np.frombuffer(x.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["share", "counts"])

    def counted(rows: DataFrame) -> np.ndarray:
        found = rows.select("text").mapInArrow(lean_batches(count), "share int, counts binary").groupBy("share").applyInArrow(add, "share int, counts binary").collect()
        counts = np.zeros((SHARES, size // SHARES), np.int64)
        for r in found:
            counts[r["share"]] = np.frombuffer(r["counts"], np.int64)
        return counts.reshape(len(ORDERS), -1)

    own = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    able = partnered(own, trusted.select("doc_id"), ["doc_id"], BITMAP_WORDS).where("_maybe")
    salted = able.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
    ids = trusted.select("doc_id", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    return np.stack([counted(salted.join(ids.hint("merge"), ["doc_id", "salt"], "left_semi")), counted(own)])


def trusted_documents(labels: DataFrame) -> DataFrame:
    """The distinct doc_ids that a label marks as good."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long")).distinct()


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """The log-likelihood ratio of each bucket; 0 where no document is trusted."""
    if not counts[0].sum():
        return np.zeros(counts.shape[1:], np.float32)
    raw = (counts[1] + SMOOTHING) / (counts[1] + SMOOTHING).sum(axis=1, keepdims=True)
    target = (counts[0] + PRIOR * raw) / (counts[0].sum(axis=1, keepdims=True) + PRIOR)
    return (np.log(target) - np.log(raw)).astype(np.float32)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    log_ratio and kept.

    base_failed: under 20 words, or over 30 % of them in repeated eight-word runs. kept:
    not base_failed, and a mean log ratio of at least threshold. A null text has no words;
    a text too short for any n-gram has ratio 0. Without trusted documents only the base
    rules reject. Columns of docs with one of the result's names are replaced. Each row
    gets its result, repeated ones too; an empty table gives no rows.
    """
    found = ngram_counts(docs, trusted_documents(labels))
    table = docs.sparkSession.sparkContext.broadcast(log_ratio(found))
    names = [x.split()[0] for x in COLUMNS.split(", ")] + ["base_failed", "log_ratio", "kept"]
    own = docs.drop(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = table.value
        for batch in batches:
            body = texts(batch.column("text"))
            rows = []
            for t in body:
                counts = base_counts(t)
                parts = grams(t.encode())
                n = sum(map(len, parts))
                mean = sum(float(ratio[i][g].sum(dtype=np.float64)) for i, g in enumerate(parts)) / n if n else 0.0
                failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
                rows.append((*counts, failed, mean, not failed and mean >= threshold))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            new = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    return own.mapInArrow(lean_batches(score), f"{schema}, {COLUMNS}, base_failed boolean, log_ratio double, kept boolean")
