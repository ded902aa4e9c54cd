"""Spelling variants: words one edit apart, found in tries of letter-group counts.

A word is arranged by its length and then by how many of its letters fall into each of
GROUPS groups: of the whole word, of its first ENDS letters and of its last ENDS. An
inserted, deleted or replaced letter changes each of these three lists of counts by at most
one up and one down (a letter pushed over the edge of the first or last ones included), so a
depth-first search that may spend a surplus and a deficit of one each in every list reaches
every word one edit away; the words of a leaf are then compared.

The trie is dealt out by its uppermost levels: a word lies in the bucket of its own first
counts, and is looked up in the buckets of all first counts within the budget. A task
builds the trie of one bucket at a time and streams the words looked up through it.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm.common import cut, partitions, small_batches

RUNS = re.compile("[a-zÀ-ÿ]+")
GROUPS, ENDS = 12, 4
LEVELS = 1 + 3 * GROUPS
#: The length and this many counts make the bucket; a bucket's trie holds about so many words.
TOP, TRIE_WORDS = 4, 20_000
FEW = 64  # words that are compared at once rather than level by level
ASKED = 60000  # words that are looked up in a trie together
CELLS = 1 << 18  # pairs compared at once
WIDE = 16  # words of so many letters are compared as numbers
LONG_TEXT, HELD_WORDS = 1 << 20, 200_000
#: Keys are sums of counts times these, modulo KEYS: linear, so that neighbours' keys follow.
KEYS = 1 << 60
_MIX = [pow(0x9E3779B97F4A7C15, i + 1, KEYS) for i in range(TOP + 1)]


def _offsets() -> list[int]:
    """What the bucket key of a word at most one edit away can differ by, modulo KEYS."""
    changes = [0, *_MIX[1:]]  # a letter of a group below the top changes no count here
    replaced = {up - down for up, down in itertools.product(changes, changes)}
    longer = {_MIX[0] + change for change in changes}
    return sorted(x % KEYS for x in replaced | longer | {-x for x in longer})


def run_counts(doc_id: object, text: str | None, modulus: int) -> Counter:
    """How often a text holds each word. Words are runs of letters in lower case (A to Z
    only); of a run whose hash with the document's id `modulus` divides, one letter goes."""
    lower = (text or "").encode().lower().decode()
    found = Counter(RUNS.findall(lower)) if len(lower) < LONG_TEXT else Counter(m.group() for m in RUNS.finditer(lower))
    name = "" if doc_id is None else str(doc_id)
    out: Counter = Counter()
    for run, times in found.items():
        h = zlib.crc32(f"{name}:{run}".encode())
        if h % modulus == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += times
    return out


def word_counts(docs: DataFrame, modulus: int = 199, letters: int = 6, times: int = 5) -> DataFrame:
    """(word, n) of the words of at least `letters` code points and `times` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def give() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in run_counts(doc_id, text, modulus).items():
                    if len(word) >= letters:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield give()
                    held.clear()
        yield give()

    counted = small_batches(docs).select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def vectors(words: list[str]) -> np.ndarray:
    """Length and the three lists of letter-group counts of each word, one row a word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    parts = [sizes[:, None]]
    for held in (words, [w[:ENDS] for w in words], [w[-ENDS:] for w in words]):
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, held), np.int64, len(words)))
        points = np.frombuffer("".join(held).encode("utf-32-le"), np.uint32)
        parts.append(np.bincount(owner * GROUPS + points % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS))
    out = np.concatenate(parts, axis=1)
    return out.astype(np.int8) if out.max(initial=0) < 64 else out


def bucket_keys(words: list[str]) -> np.ndarray:
    """One number for the length and the first TOP counts."""
    top = vectors(words)[:, : TOP + 1].astype(np.uint64)
    return ((top * np.array(_MIX, np.uint64)).sum(axis=1, dtype=np.uint64) % np.uint64(KEYS)).view(np.int64)


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def _packed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each word's size (0 if it is to be compared as text) and its letters, from the front
    and from the back, as numbers of eight letters."""
    coded = [w.encode("latin-1", "ignore") for w in words]
    fits = [len(c) == len(w) <= WIDE and 0 not in c for c, w in zip(coded, words, strict=True)]
    rows = b"".join((c.ljust(WIDE, b"\0") + c[::-1].ljust(WIDE, b"\0")) if ok else bytes(2 * WIDE) for c, ok in zip(coded, fits, strict=True))
    return np.array([len(w) * ok for w, ok in zip(words, fits, strict=True)], np.int64), np.frombuffer(rows, "<u8").reshape(-1, 4)


def _equal_bytes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How many of 16 bytes, lowest first, are zero before one is not."""
    low = np.bitwise_count((first & -first) - np.uint64(1)) >> 3
    high = np.bitwise_count((second & -second) - np.uint64(1)) >> 3
    return np.where(first != 0, low, 8 + high)


def _differing(x: np.ndarray) -> np.ndarray:
    """How many bytes of each number are not zero."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    return np.bitwise_count((((x & low) + low) | x) & ~low)


def _close(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Whether pairs of packed words, which are all of one size or all one longer on the
    same side, are one edit apart."""
    x = a ^ b
    if len(x) and sizes_a[0] == sizes_b[0]:
        return _differing(x[:, 0]) + _differing(x[:, 1]) == 1
    return _equal_bytes(x[:, 0], x[:, 1]) + _equal_bytes(x[:, 2], x[:, 3]) >= np.minimum(sizes_a, sizes_b)


class Trie:
    """Words sorted by their vectors: a node is a range of rows that agree up to a level."""

    def __init__(self, words: list[str]) -> None:
        rows = vectors(words)
        self.order = np.lexsort(rows.T[::-1])
        self.rows = rows[self.order]
        self.words = [words[i] for i in self.order]
        self.sizes, self.letters = _packed(self.words)

    def near(self, asked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places in asked, and among the words given, of all pairs one edit apart."""
        wanted, (sizes, letters) = vectors(asked), _packed(asked)
        none = np.zeros(len(asked), np.int8)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        # Ranges still to visit, the last one first, with the words that may still spend
        # budget there.
        todo = [(0, 0, len(self.words), np.arange(len(asked)), none, none)]
        while todo:
            level, low, high, who, surplus, deficit = todo.pop()
            if level == LEVELS or (level and high - low <= FEW):
                found += self._verified(who, low, high, asked, sizes, letters)
                continue
            if level > 1 and level % GROUPS == 1:  # the next list has a budget of its own
                surplus = deficit = none[: len(who)]
            column = self.rows[low:high, level]
            edges = np.flatnonzero(np.diff(column, prepend=column[0] - 1))
            here = wanted[who, level]
            for a, b in zip(edges, [*edges[1:], high - low], strict=True):
                step = here - column[a]
                if level == 0:
                    # A longer word has no deficit to spend, a shorter one no surplus.
                    for more in (-1, 0, 1):
                        kept = np.flatnonzero(step == more)
                        if len(kept):
                            todo.append((1, low + a, low + b, kept, none[kept] + (more < 0), none[kept] + (more > 0)))
                    continue
                up, down = surplus + np.maximum(step, 0), deficit - np.minimum(step, 0)
                kept = np.flatnonzero((up <= 1) & (down <= 1))
                if len(kept):
                    todo.append((level + 1, low + a, low + b, who[kept], up[kept], down[kept]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        who, places = (np.concatenate(x) for x in zip(*found, strict=True))
        return who, self.order[places]

    def _verified(self, who: np.ndarray, low: int, high: int, asked: list[str], sizes: np.ndarray, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs one edit apart of those asked for and the words of a leaf."""
        for at in range(0, len(who), max(1, CELLS // (high - low))):
            part = who[at : at + max(1, CELLS // (high - low))]
            rows, places = np.repeat(part, high - low), np.tile(np.arange(low, high), len(part))
            a, b = sizes[rows], self.sizes[places]
            good = (a > 0) & (b > 0) & _close(letters[rows], self.letters[places], a, b)
            for i in np.flatnonzero((a == 0) | (b == 0)).tolist():
                good[i] = one_edit(asked[rows[i]], self.words[places[i]])
            yield rows[good], places[good]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) of the words of (word, n) that have words one edit apart:
    how many, the most frequent of them (of equally frequent ones the first in code-point
    order) and its n. A key of more words than a trie holds is dealt to several tries."""

    def key_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = bucket_keys(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys)], ["word", "n", "key"])

    keyed = cut(words.mapInArrow(key_of, "word string, n long, key long"))
    tries = max(partitions(words), math.ceil(keyed.count() / TRIE_WORDS))
    # A key's words are counted and dealt to `parts` tries each.
    parts = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TRIE_WORDS).alias("parts"))
    bucket = F.pmod(F.xxhash64("key", "part"), F.lit(tries)).alias("bucket")
    stored = keyed.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts"))).select(bucket, F.lit(0).alias("kind"), "word", "n")
    offsets = F.array(*[F.lit(x).cast("long") for x in _offsets()])
    reached = F.explode(F.transform(offsets, lambda x: F.pmod(F.col("key") + x, F.lit(KEYS))))
    asked = keyed.select("word", "n", reached.alias("key")).join(parts, "key")
    asked = asked.select("word", "n", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    asked = asked.select(bucket, F.lit(1).alias("kind"), "word", "n").distinct()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, words_here, counts_here, names_here, trie = None, [], [], [], None

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal trie
            if words_here and names_here:
                trie = trie or Trie(words_here)
                who, near = trie.near(names_here)
                # Of each word the most frequent near one, first in code-point order.
                ranks = np.empty(len(words_here), np.int64)
                ranks[sorted(range(len(words_here)), key=lambda j: (-counts_here[j], words_here[j]))] = np.arange(len(words_here))
                best = np.full(len(names_here), len(words_here))
                np.minimum.at(best, who, ranks[near])
                order, count = np.argsort(ranks), np.bincount(who, minlength=len(names_here))
                met = np.flatnonzero(count)
                top = order[best[met]].tolist()
                out = [pa.array([names_here[i] for i in met.tolist()], pa.string()), pa.array(count[met]), pa.array([words_here[j] for j in top], pa.string())]
                yield pa.RecordBatch.from_arrays([*out, pa.array([counts_here[j] for j in top], pa.int64())], ["word", "n_near", "near", "near_n"])
            names_here.clear()

        for batch in batches:
            buckets, kinds = (batch.column(c).to_numpy() for c in (0, 1))
            names, counts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            edges = np.flatnonzero((np.diff(buckets, prepend=buckets[:1] - 1) != 0) | (np.diff(kinds, prepend=-1) != 0)) if len(buckets) else []
            for a, b in zip(edges, [*edges[1:], len(buckets)], strict=True):
                if buckets[a] != here:
                    yield from answers()
                    here, words_here, counts_here, trie = buckets[a], [], [], None
                if kinds[a] == 0:
                    words_here += names[a:b]
                    counts_here += counts[a:b]
                    continue
                names_here += names[a:b]
                if len(names_here) >= ASKED:
                    yield from answers()
        yield from answers()

    rows = stored.unionByName(asked).repartition(partitions(words), "bucket").sortWithinPartitions("bucket", "kind")
    met = rows.mapInArrow(search, "word string, n_near long, near string, near_n long")
    # A word meets several buckets; a near word lies in one of them.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.near", (-F.col("best.less")).alias("near_n"))


def _roots(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) of links (word, form): where following the forms ends. A form is at
    least `ratio` times as frequent, so a chain has at most log(most) links, and each round
    halves what is left of it."""
    now = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(math.log(max(most, 2), ratio) + 1))):
        now = cut(now)
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return now


def variants(docs: DataFrame, modulus: int = 199, letters: int = 6, times: int = 5, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of at least `letters` code points
    that occurs at least `times` times.

    Two words are near if one edit apart. A word's form is its most frequent near word (of
    equally frequent ones the first in code-point order) if that is at least `ratio` times
    as frequent, else null; root is where following forms ends, or the word itself. A null
    text has no words, a null doc_id counts as empty text in the hash, and rows that repeat
    each count. Very long texts are read run by run. Other columns are not read, and an
    empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent, or forms could go round")
    words = cut(word_counts(docs, modulus, letters, times))
    joined = words.join(near_words(words), "word", "left")
    good = F.col("near_n") >= ratio * F.col("n")
    known = cut(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("near")).alias("form"), F.when(good, F.col("near_n")).alias("form_n"),
        )
    )
    most = known.agg(F.max("n")).first()[0]
    roots = _roots(known.where("form IS NOT NULL"), most or 1, ratio)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
