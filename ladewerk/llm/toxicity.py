"""Toxicity by a small convolutional text classifier, trained in numpy.

Words are hashed to embeddings; filters of several widths slide over them, each filter's
largest answer in the text is kept, and a logistic layer scores these. It is trained on all
labelled documents that may be learned from: in each epoch every task goes over its own ones
from the same network, and what they change is averaged. A fifth of the documents calibrates
the score and sets a decision threshold for each language. The score itself sees the text alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm.common import cut, held_out, released, small_batches, texts
from ladewerk.operators.joins import join_unique

BUCKETS, DIMENSIONS, FILTERS = 1 << 15, 16, 12
WIDTHS = (1, 2, 3)
PAD = 0
EPOCHS, DOCS_A_STEP, RATE, EMBEDDING_RATE = 6, 32, 0.01, 0.01
#: Share of words that training blanks, so that no single rare word tells a text.
BLANK = 0.3
#: After the first epoch, texts whose score was this close to the label are mostly left out.
EASY, EASY_SHARE = 0.05, 0.2
#: About how many documents a task learns from between two averages; one document in APART
#: calibrates instead.
SHARD_DOCS, APART = 8_000, 5
#: Raw scores are counted in steps of 1 / STEPS up to MOST_RAW either way, changes in 2 ** -40.
STEPS, MOST_RAW, FINE = 256, 30, float(1 << 40)
CUT = 0.7
CHUNK_WORDS = 1 << 16
#: What separates words: ASCII but letters, digits and the apostrophe.
_CLEAN = bytes(c if chr(c).isalnum() or c == 39 or c > 127 else 32 for c in range(128)) + bytes(range(128, 256))


def word_ids(text: str) -> np.ndarray:
    """Hashed words, lower-cased, with padding so that every filter fits."""
    words = text.lower().encode().translate(_CLEAN).split()
    ids = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % (BUCKETS - 1) + 1
    # A text of no words has no place for the widest filter but in padding of its width.
    return np.concatenate((ids, np.full(max(WIDTHS) - min(1, len(words)), PAD, np.int64)))


@dataclass
class Model:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width: (width, DIMENSIONS, FILTERS)
    shifts: dict[int, np.ndarray]
    weights: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str | None, float] = field(default_factory=dict)

    def answers(self) -> list[tuple[list[np.ndarray], np.ndarray]]:
        """For each width, each bucket's part in the filters' answers at each offset."""
        return [([(self.embedding @ f).astype(np.float32) for f in self.filters[w]], self.shifts[w].astype(np.float32)) for w in WIDTHS]

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        raw = np.maximum(pooled, 0) @ self.weights + self.bias
        return self.scale[0] * raw + self.scale[1]


def pooled(ids: np.ndarray, answers: list) -> np.ndarray:
    """The largest answer of every filter over a text of any length."""
    best = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
    for at in range(0, len(ids), CHUNK_WORDS):
        own = ids[at : at + CHUNK_WORDS + max(WIDTHS) - 1]
        for i, (parts, shift) in enumerate(answers):
            n = len(own) - len(parts) + 1
            if n <= 0:
                continue
            total = parts[0][own[:n]]
            for j, p in enumerate(parts[1:], 1):
                total += p[own[j : j + n]]
            part = best[i * FILTERS : (i + 1) * FILTERS]
            np.maximum(part, total.max(axis=0) + shift, out=part)
    return best


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Adam:
    def __init__(self):
        self.state: dict[str, list] = {}

    def step(self, name: str, value: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None, rate: float = RATE) -> None:
        m, v, t = self.state.setdefault(name, [np.zeros_like(value), np.zeros_like(value), 0])
        self.state[name][2] = t = t + 1
        own = slice(None) if rows is None else rows
        m[own] = 0.9 * m[own] + 0.1 * grad
        v[own] = 0.99 * v[own] + 0.01 * grad * grad
        value[own] -= rate * (m[own] / (1 - 0.9**t)) / (np.sqrt(v[own] / (1 - 0.99**t)) + 1e-6)


def _start(share: float, seed: int = 0) -> Model:
    """The network before it has seen a text; share of the texts have label 1."""
    random = np.random.default_rng(seed)
    return Model(
        random.normal(0, 0.01, (BUCKETS, DIMENSIONS)),
        {w: random.normal(0, 0.3, (w, DIMENSIONS, FILTERS)) for w in WIDTHS},
        {w: np.zeros(FILTERS) for w in WIDTHS},
        random.normal(0, 0.3, len(WIDTHS) * FILTERS),
        float(np.log(share / (1 - share))),
    )


def _packed(model: Model) -> np.ndarray:
    """All numbers of a network that are learned, as rows of one width."""
    dense = np.concatenate([*(model.filters[w].ravel() for w in WIDTHS), *(model.shifts[w] for w in WIDTHS), model.weights, [model.bias]])
    return np.concatenate((model.embedding, np.pad(dense, (0, -len(dense) % DIMENSIONS)).reshape(-1, DIMENSIONS)))


def _unpacked(rows: np.ndarray) -> Model:
    dense, at = rows[BUCKETS:].ravel().copy(), 0

    def take(*shape: int) -> np.ndarray:
        nonlocal at
        at += int(np.prod(shape))
        return dense[at - int(np.prod(shape)) : at].reshape(shape)

    filters = {w: take(w, DIMENSIONS, FILTERS) for w in WIDTHS}
    shifts = {w: take(FILTERS) for w in WIDTHS}
    return Model(rows[:BUCKETS].copy(), filters, shifts, take(len(WIDTHS) * FILTERS), float(take(1)[0]))


def train_epoch(model: Model, docs: list[np.ndarray], labels: np.ndarray, epoch: int = 0) -> None:
    """Move the network once over texts (as word ids) and 0/1 labels."""
    random = np.random.default_rng(epoch)
    adam, bias = _Adam(), np.array([model.bias])
    miss = np.ones(len(docs))
    if epoch:
        parts = model.answers()
        miss = np.abs(sigmoid(np.array([model.logit(pooled(d, parts)) for d in docs])) - labels)
    if len(docs):
        order = random.permutation(np.flatnonzero((miss > EASY) | (random.random(len(docs)) < EASY_SHARE)))
        for at in range(0, len(order), DOCS_A_STEP):
            batch = order[at : at + DOCS_A_STEP]
            seen = {d: np.where(random.random(len(docs[d])) < BLANK, PAD, docs[d]) for d in batch.tolist()}
            used = np.unique(np.concatenate(list(seen.values())))
            small = model.embedding[used].astype(np.float32)
            answers = [[small @ f.astype(np.float32) for f in model.filters[w]] for w in WIDTHS]
            top = np.empty((len(batch), len(WIDTHS), FILTERS), np.int64)
            value = np.empty((len(batch), len(WIDTHS), FILTERS))
            for b, d in enumerate(batch.tolist()):
                ids = np.searchsorted(used, seen[d])
                for i, w in enumerate(WIDTHS):
                    n = len(ids) - w + 1
                    total = sum(answers[i][j][ids[j : j + n]] for j in range(w))
                    top[b, i] = total.argmax(axis=0)
                    value[b, i] = total[top[b, i], np.arange(FILTERS)] + model.shifts[w]
            hidden = np.maximum(value, 0).reshape(len(batch), -1)
            off = (sigmoid(hidden @ model.weights + bias[0]) - labels[batch]) / len(batch)
            back = (off[:, None] * model.weights).reshape(value.shape) * (value > 0)
            grad_rows: list[np.ndarray] = []
            grad_values: list[np.ndarray] = []
            for i, w in enumerate(WIDTHS):
                g = back[:, i]
                near = np.stack([np.stack([seen[d][top[b, i] + j] for j in range(w)]) for b, d in enumerate(batch.tolist())])  # batch, w, filter
                words = model.embedding[near]
                # The gradients of the embeddings use the filters before their own step.
                grad_rows.append(near.ravel())
                grad_values.append((g[:, None, :, None] * model.filters[w].transpose(0, 2, 1)[None]).reshape(-1, DIMENSIONS))
                adam.step(f"filter{w}", model.filters[w], np.einsum("bf,bwfd->wdf", g, words))
                adam.step(f"shift{w}", model.shifts[w], g.sum(axis=0))
            adam.step("weights", model.weights, hidden.T @ off)
            adam.step("bias", bias, np.array([off.sum()]))
            rows, place = np.unique(np.concatenate(grad_rows), return_inverse=True)
            total = np.zeros((len(rows), DIMENSIONS))
            np.add.at(total, place, np.concatenate(grad_values))
            adam.step("embedding", model.embedding, total, rows, EMBEDDING_RATE)
    model.bias = float(bias[0])


def calibrate(model: Model, raw: np.ndarray, labels: np.ndarray, langs: list[str | None], share: np.ndarray) -> None:
    """Fit the score's scale by logistic regression on the raw score and move it so that CUT
    is the threshold of the best F1. Then set each language's threshold of the best F1, in
    hundredths; CUT where a language has fewer than ten documents of a label. share says how
    many documents have such a raw score, label and language."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * raw + b)
        w = share * p * (1 - p) + 1e-6
        grad = np.array([(share * (p - labels) * raw).sum() + 1e-2 * (a - 1), (share * (p - labels)).sum() + 1e-2 * b])
        hess = np.array([[(w * raw * raw).sum() + 1e-2, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(hess, grad)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    model.scale = (max(a, 1e-3), b)

    def best(own: np.ndarray) -> float:
        y, s, k = labels[own], score[own], share[own]
        grid = np.arange(5, 96) / 100
        f1 = [2 * k[(s >= t) & (y == 1)].sum() / max(1e-9, k[s >= t].sum() + k[y == 1].sum()) for t in grid]
        tops = np.flatnonzero(np.array(f1) == max(f1))
        return float(grid[tops[len(tops) // 2]])

    score = sigmoid(model.scale[0] * raw + model.scale[1])
    middle = best(np.ones(len(labels), bool))
    model.scale = (model.scale[0], b + float(np.log(CUT / (1 - CUT)) - np.log(middle / (1 - middle))))
    score = sigmoid(model.scale[0] * raw + model.scale[1])
    for lang in sorted(set(langs), key=str):
        own = np.array([x == lang for x in langs])
        if min((share * labels)[own].sum(), (share * (1 - labels))[own].sum()) >= 10:
            model.thresholds[lang] = best(own)


def _labelled(docs: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """id, toxic, lang and word ids of the documents to learn from, a shard in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([word_ids(t).astype(np.int32).tobytes() for t in texts(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "toxic", "lang")), ids], ["id", "toxic", "lang", "ids"])

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text", lang.alias("lang"))
    met = join_unique(rows, known, ["id"], "inner").select("id", "toxic", "lang", "text")
    read = met.mapInArrow(run, "id long, toxic boolean, lang string, ids binary")
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    return cut(read.withColumn("shard", shard).repartitionById(shards, "shard").drop("shard"))


def _epoch_changes(rows: DataFrame, packed: np.ndarray, epoch: int) -> pa.Table:
    """What an epoch changes in the network: the mean over the tasks that change a row."""
    shared = rows.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = []
        for batch in batches:
            docs += zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), batch.column("toxic").to_pylist(), strict=True)
        if not docs:
            return
        docs.sort(key=lambda d: (zlib.crc32(str(d[0]).encode()), *d))
        model = _unpacked(shared.value)
        train_epoch(model, [np.frombuffer(d[1], np.int32) for d in docs], np.array([float(d[2]) for d in docs]), epoch)
        moved = np.rint((_packed(model) - shared.value) * FINE).astype(np.int64)
        own = np.flatnonzero(moved.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(own), *(pa.array(moved[own, i]) for i in range(DIMENSIONS))], ["row", *(f"d{i}" for i in range(DIMENSIONS))])

    columns = [f"d{i}" for i in range(DIMENSIONS)]
    moved = rows.select("id", "toxic", "ids").mapInArrow(run, ", ".join(["row long", *(f"{c} long" for c in columns)]))
    # Sums of whole numbers are the same in any order. One row for each row of the network.
    mean = moved.groupBy("row").agg(*[(F.sum(c) / F.count(F.lit(1))).alias(c) for c in columns])
    with released(rows.sparkSession):
        return mean.toArrow()


def _raw_counts(rows: DataFrame, model: Model) -> list:
    """raw score (in steps), toxic, lang and n of documents."""
    shared = rows.sparkSession.sparkContext.broadcast((model, model.answers()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, answers = shared.value
        for batch in batches:
            raw = [float(model.logit(pooled(np.frombuffer(b, np.int32), answers))) for b in batch.column("ids").to_pylist()]
            step = np.rint(np.clip(np.array(raw, float), -MOST_RAW, MOST_RAW) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("toxic"), batch.column("lang")], ["step", "toxic", "lang"])

    steps = rows.select("toxic", "lang", "ids").mapInArrow(run, "step long, toxic boolean, lang string")
    return steps.groupBy("step", "toxic", "lang").agg(F.count(F.lit(1)).alias("n")).orderBy("step", "toxic", "lang").collect()


def fit(docs: DataFrame, labels: DataFrame, shard_docs: int = SHARD_DOCS) -> Model:
    """Train and calibrate on all labelled documents outside the held-out third.

    Without both labels the score is the share of label 1, smoothed."""
    allowed = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = allowed.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.select("id", (F.col("toxic") == 1).alias("toxic"))
    held = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = _labelled(docs, known, max(1, -(-sum(held.values()) // shard_docs)))
    apart = F.pmod(F.xxhash64("id", F.lit("apart")), F.lit(APART)) == 0
    learn, check = rows.where(~apart), rows.where(apart)
    seen = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        share = (held.get(True, 0) + 1) / (sum(held.values()) + 2)
        zero = {w: np.zeros((w, DIMENSIONS, FILTERS)) for w in WIDTHS}
        return Model(np.zeros((BUCKETS, DIMENSIONS)), zero, {w: np.zeros(FILTERS) for w in WIDTHS}, np.zeros(len(WIDTHS) * FILTERS), float(np.log(share / (1 - share))))
    packed = _packed(_start((seen[True] + 1) / (sum(seen.values()) + 2)))
    for epoch in range(EPOCHS):
        moved = _epoch_changes(learn, packed, epoch)
        packed[moved.column("row").to_numpy()] += np.stack([moved.column(f"d{i}").to_numpy() for i in range(DIMENSIONS)], axis=1) / FINE
    model = _unpacked(packed)
    counts = _raw_counts(check, model)
    if len({r["toxic"] for r in counts}) == 2:
        columns = [np.array([float(r[c]) for r in counts]) for c in ("step", "toxic", "n")]
        calibrate(model, columns[0] / STEPS, columns[1], [r["lang"] for r in counts], columns[2])
    return model


def toxicity(docs: DataFrame, labels: DataFrame, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted (score of at least 0.7) and flagged (score of at
    least the threshold of the document's language) of each document.

    docs: doc_id, text and, for flagged alone, lang; labels: doc_id, toxic. A null or empty
    text is padding alone; an unknown or null language has threshold 0.7. A doc_id labelled
    twice counts as toxic if one label says so. Repeated rows each get their result; an
    empty table gives no rows.
    """
    model = fit(small_batches(docs), labels, shard_docs)
    shared = docs.sparkSession.sparkContext.broadcast((model, model.answers()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, answers = shared.value
        for batch in batches:
            out = [float(sigmoid(model.logit(pooled(word_ids(t), answers)))) for t in texts(batch.column("text"))]
            limits = [model.thresholds.get(x, CUT) for x in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(out, pa.float64()), pa.array([int(s >= CUT) for s in out], pa.int32()), pa.array([s >= t for s, t in zip(out, limits, strict=True)], pa.bool_())],
                ["doc_id", "held_out", "score", "predicted", "flagged"],
            )

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = small_batches(docs).select(F.col("doc_id").cast("long"), "text", lang.alias("lang"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, flagged boolean")
