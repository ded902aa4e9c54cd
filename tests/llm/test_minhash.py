"""Bottom-k near-duplicates against all pairs of sets."""

from __future__ import annotations

import random

import pytest
from ladewerk.llm import minhash

DOCS = "doc_id long, text string, n long, node long, component long, digest string"


def _set(text, size):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for part in words for w in part.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if len(words) <= size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def _expected(rows, size=4, percent=80):
    sets = [_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        component = min(ids, default=None)
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


def _words(r, n):
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def _changed(r, words, n):
    words = list(words)
    for at in r.sample(range(len(words)), min(n, len(words))):
        words[at] = f"z{r.randrange(10**9)}"
    return words


def _rows():
    r = random.Random(11)
    texts = []
    for length in (3, 4, 5, 30, 95, 99, 100, 101, 120, 400, 1500):
        for changes in (0, 1, 2, 4, length // 40, length // 25):
            base = _words(r, length)
            texts += [base, _changed(r, base, changes)]
    centre = _words(r, 300)
    texts += [_changed(r, centre, 9) for _ in range(60)] + [centre] + [centre] * 5
    passage = _words(r, 200)  # in texts that hold little else, but enough to differ
    texts += [passage + _words(r, 60) for _ in range(50)]
    texts += [_words(r, 50) + passage + _words(r, 300) for _ in range(50)]
    r.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    odd = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One  two"), (1004, "one\x0btwo"), (1005, "ÉCOLE a"), (1006, "école a"), (None, "one two"), (None, None), (2, "again another text"), (2, "again another text"), (1007, " ".join(["a"] * 3000))]
    return rows + odd


@pytest.mark.parametrize("block", [512, 8])
def test_groups_are_those_of_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = _rows()
    docs = spark.createDataFrame([(*row, 7, 7, 7, "x") for row in rows], DOCS).repartition(5)
    found = [tuple(r) for r in minhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(_expected(rows), key=str)


def test_copies_near_each_other_but_not_their_centre(spark):
    """A large group around one text, most too far from it and each other, some in pairs."""
    r = random.Random(5)
    base = _words(r, 260)
    texts = [base]
    for k in range(220):
        far = _changed(r, base, r.choice([4, 9, 14, 17, 25]))
        texts += [far] if k % 3 else [far, _changed(r, far, r.choice([2, 8, 11, 13]))]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = [tuple(x) for x in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()]
    expected = _expected(rows)
    assert len({x[2] for x in expected}) > 40
    assert sorted(found) == sorted(expected)


def test_other_shingles_and_similarity(spark):
    rows = _rows()[:120]
    found = [tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 0.9).collect()]
    assert sorted(found, key=str) == sorted(_expected(rows, 2, 90), key=str)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    assert [tuple(r) for r in minhash.near_duplicates(spark.createDataFrame([(1, None, 0, 0, 0, "")], DOCS)).collect()] == [(1, 0, 1, True)]
