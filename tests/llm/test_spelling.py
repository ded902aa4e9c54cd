"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from ladewerk.llm import spelling

DOCS = "doc_id long, text string, n long, word string"


def _expected(rows, modulus=199, letters=6, times=5, ratio=5):
    counts = Counter()
    for doc_id, text, *_ in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % modulus == 0 else run] += 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= times}
    near = {w: [v for v in words if spelling.one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= ratio * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def _rows():
    r = random.Random(7)
    base = ["garden", "gardens", "gardener", "straße", "Ünterwegs", "naïveté", "aaaaaaaa", "harbour", "harbor", "x" * 300, "y" * 40 + "z"]
    words = []
    for place, w in enumerate(base):
        words += [w] * (5 * 6 ** (place % 4))
        for _ in range(12):
            at, kind, letter = r.randrange(len(w) + 1), r.randrange(3), r.choice("abcéßx")
            changed = w[:at] + letter + w[at + (kind > 0) :] if kind < 2 else w[:at] + w[at + 1 :]
            words += [changed] * r.choice([1, 5, 6, 30])
    words += ["short"] * 20 + ["tied11", "tiedab", "tiedac", "tiedad"] * 5 + ["tiedax"] * 1
    r.shuffle(words)
    rows = [(i if i % 9 else None, " ".join(words[i::40]).upper() if i == 5 else "-".join(words[i::40]), 1, "w") for i in range(40)]
    return [*rows, rows[3], (90, None, 1, ""), (91, "", 1, ""), (92, "1234 ..", 1, ""), (93, "garden " * 300_000, 1, "")]


@pytest.mark.parametrize("modulus", [199, 3])
def test_every_pair_is_found(spark, modulus, monkeypatch):
    monkeypatch.setattr(spelling, "TRIE_WORDS", 7)  # several tries, some keys dealt to two
    monkeypatch.setattr(spelling, "FEW", 2)
    rows = _rows()
    found = spelling.variants(spark.createDataFrame(rows, DOCS).repartition(6), modulus).collect()
    assert {tuple(r) for r in found} == _expected(rows, modulus) and len(found) == len({r.word for r in found})


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], DOCS)).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, "ab cd", 0, "")], DOCS)).collect() == []


def test_chains_lead_to_the_root(spark):
    chain = [("planter", 5), ("planters", 30), ("planterss", 160), ("plantersst", 900), ("plantersstt", 5000)]
    rows = [(None, " ".join(w for w, n in chain for _ in range(n)), 0, "")]
    found = {r.word: r for r in spelling.variants(spark.createDataFrame(rows, DOCS), modulus=1 << 40).collect()}
    assert {r.root for r in found.values()} == {"plantersstt"} and found["planter"].form == "planters" and found["plantersstt"].form is None


def test_one_edit():
    for a, b, near in (("abc", "abc", False), ("abc", "abd", True), ("abc", "ab", True), ("abc", "acb", False), ("abc", "xabc", True), ("", "a", True), ("ab", "abcd", False)):
        assert spelling.one_edit(a, b) is near and spelling.one_edit(b, a) is near
