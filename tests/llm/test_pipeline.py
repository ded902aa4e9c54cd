"""The corpus pipeline against a plain version of its stages, on a small corpus with copies,
shared passages, personal data, nulls and rows without words."""

from __future__ import annotations

import math
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from ladewerk.llm import quality

public_tokenizers = pytest.importorskip("public_tokenizers")
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _vocabulary(r, n):
    return ["".join(r.choice(LETTERS) for _ in range(r.randrange(3, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    words = _vocabulary(r, 400)
    text = lambda n: [r.choice(words) for _ in range(n)]

    def edited(base, n):
        out = list(base)
        for at in r.sample(range(len(out)), n):
            out[at] = r.choice(words)
        return out

    docs = [text(r.randrange(30, 200)) for _ in range(30)]
    passage = text(40)
    docs += [text(60) + passage + text(50) for _ in range(8)]  # repeated, but not near
    for copies in (2, 5, 60):
        base = text(150)
        docs += [base] * 3 + [edited(base, r.choice([1, 2, 3])) for _ in range(copies)]
    rows = [(i, " ".join(d), "en", "web") for i, d in enumerate(docs)]
    mail = lambda i: " ".join(text(30)) + f" write to ann.b{LETTERS[i]}@post.example.org or see 10.2.3.{i} " + " ".join(text(30))
    rows += [(500 + i, mail(i), "de", "mail") for i in range(12)]
    rows += [(600 + i, " ".join("#" + w + "|<>" for w in text(60)), "en", "junk") for i in range(5)]
    rows += [(700, None, "en", None), (701, "", None, "web"), (702, "too short", "en", "web"), (703, " ".join(text(10) * 9), "en", "web"), (0, rows[0][1], "en", "web"), (None, " ".join(text(80)), "fr", "web")]
    r.shuffle(rows)
    labels = [(i, int(i < 30 or 500 <= i < 512), 0) for i in range(0, 620) if i % 2 == 0 or i < 20]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    rows, labels = corpus
    where = str(tmp_path_factory.mktemp("sf"))
    docs = [(*row, None if row[1] is None else len(row[1])) for row in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


def _plain_quality(rows, labels):
    trusted = {i for i, good, _ in labels if good}
    counts = np.zeros((2, 2, 1 << quality.BUCKET_BITS))
    for doc_id, text, *_ in rows:
        for i, g in enumerate(quality.grams((text or "").encode())):
            np.add.at(counts[1, i], g, 1)
            if doc_id in trusted:
                np.add.at(counts[0, i], g, 1)
    raw = (counts[1] + 1) / (counts[1] + 1).sum(axis=1, keepdims=True)
    target = (counts[0] + (1 << 16) * raw) / (counts[0].sum(axis=1, keepdims=True) + (1 << 16))
    ratio = np.log(target / raw)
    out = []
    for row in rows:
        words = (row[1] or "").split()
        runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        repeated = {i + k for i, x in enumerate(runs) if runs.count(x) > 1 for k in range(8)}
        parts = quality.grams((row[1] or "").encode())
        n = sum(map(len, parts))
        mean = sum(ratio[i][g].sum() for i, g in enumerate(parts)) / n if n else 0
        if len(words) >= 20 and 100 * len(repeated) <= 30 * len(words) and mean >= quality.THRESHOLD:
            out.append(row)
    return out


def _plain_near(rows):
    rows = sorted({(r[0], r[1]): r for r in rows}.values(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    lead = list(range(len(rows)))

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                lead[max(x, y)] = min(x, y)
    return [r for i, r in enumerate(rows) if top(i) == i]


def _plain_suffix(rows):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        text, gone = r[1], set()
        for i in range(len(text) - 99):
            if text[i : i + 100] in seen:
                gone |= set(range(i, i + 100))
            seen.add(text[i : i + 100])
        out.append((r[0], "".join(c for i, c in enumerate(text) if i not in gone), *r[2:]))
    return out


def _plain_private(rows):
    mail, ip = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"\d+\.\d+\.\d+\.\d+"
    return [(r[0], re.sub(ip, "[IP]", re.sub(mail, "[EMAIL]", r[1])), *r[2:]) for r in rows]


def test_each_stage_and_the_whole_are_those_of_the_plain_version(spark, corpus, folder):
    from tokenizers import Tokenizer

    rows, labels = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = [_plain_quality(rows, labels)]
    for step in (_plain_near, _plain_suffix, _plain_private):
        plain.append(step(plain[-1]))
    assert 40 < len(plain[1]) < len(plain[0]) - 50 and sum(len(r[1]) for r in plain[2]) < sum(len(r[1]) for r in plain[1]) - 1000
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], plain, strict=True):
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        assert sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()), key=str) == sorted(expected, key=str), name
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r[0]: [*tokenizer.encode(r[1], add_special_tokens=False).ids, 0] for r in plain[-1]}
    pieces = corpus_pipeline.run(spark, folder).collect()
    taken = dict.fromkeys(ids, 0)
    used: dict = {}
    for p in sorted(pieces, key=lambda p: (str(p["doc_id"]), p["start"])):
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["start"] == taken[p["doc_id"]] and p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        taken[p["doc_id"]] += p["length"]
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert all(taken[d] == len(i) for d, i in ids.items())
    assert max(sum(n for _, n in s) for s in used.values()) <= 1024
    assert len(used) <= math.ceil(sum(map(len, ids.values())) / 1024) + 2


def test_an_empty_corpus(spark, tmp_path):
    where = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    assert corpus_pipeline.run(spark, where).count() == 0
