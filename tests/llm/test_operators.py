"""Each operator against a plain version, on small tables with the awkward cases."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from ladewerk.llm import boosting, bwt, chat, common, golay, graph_search, near_documents, packing, pii, quality, sentencepiece_fst, simhash, suffix_dedup, template, toxicity, warc
from ladewerk.llm.components import components
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, n_bytes long"


def _words(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(["alpha", "Beta", "gamma,", "délta", "eps", "zeta."]) + str(r.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    shared = _words(40, 1)
    return [
        (1, shared, "en", 1), (2, shared, "en", 2), (2, shared, "en", 2), (3, _words(30, 2) + shared + _words(9, 3), None, None),
        (None, shared[:150], "de", 0), (4, None, "fr", 1), (5, "", "es", 1), (6, " \n\t", "en", 1), (7, "x" * 70_000, "en", 1),
        (8, _words(3000, 4), "en", 1), (9, _words(3000, 4) + " more", "en", 1), (10, "é" * 120, "fr", 1), (11, "é" * 60, "fr", 1),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_suffix_dedup_removes_what_starts_earlier(docs, none, rows):
    seen, expected = set(), {}
    for known, d, body in sorted({(d is not None, d or 0, (t or "").encode()) for d, t, *_ in rows}):
        cover = bytearray(len(body))
        for i in range(len(body) - 99):
            if body[i : i + 100] in seen:
                cover[i : i + 100] = b"\1" * 100
            seen.add(body[i : i + 100])
        runs = len(re.findall(rb"\x01+", cover))
        expected[d if known else None] = (len(body), sum(cover), runs, bytes(b for b, c in zip(body, cover, strict=True) if not c))
    found = suffix_dedup.suffix_repeats(docs, 100, ("lang",)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == expected[r["doc_id"]]
    small = suffix_dedup.suffix_repeats(docs, 100, block_bytes=1000).collect()
    assert sorted(str(r) for r in small) == sorted(str(r) for r in suffix_dedup.suffix_repeats(docs, 100).collect())
    assert suffix_dedup.suffix_repeats(none).count() == 0


def test_merged_transforms_find_repeats():
    r = random.Random(5)
    strings = sorted({"".join(r.choice("ab") for _ in range(60)).encode() * 3 + bytes([97 + i % 26]) for i in range(30)})
    strings = [s[: 100 + i % 40] for i, s in enumerate(strings)] + [strings[0][3:140]]
    starts = np.array([len(s) - 99 for s in strings])
    seen, expected = set(), []
    for s in strings:
        for i in range(len(s) - 99):
            expected.append(s[i : i + 100] in seen)
            seen.add(s[i : i + 100])
    found = bwt.repeats(strings, starts, np.arange(len(strings)) << 8, 100)
    assert found.tolist() == expected


def test_golay_words_two_bits_apart_share_an_index():
    words = np.random.default_rng(0).integers(0, 1 << 23, 300)
    a, n = golay.indices(words)
    for i in range(0, 23, 3):
        for j in range(i, 23):
            b, m = golay.indices(words ^ (1 << i) ^ (1 << j if i != j else 0))
            for x, k, y, q in zip(a, n, b, m, strict=True):
                assert set(x[:k]) & set(y[:q])


def test_simhash_components(docs, none, rows):
    prints = {}
    for d, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints[d] = sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))
    found = simhash.simhash_components(docs).collect()
    assert len(found) == len(rows)
    assert all(int(r["fingerprint"], 16) == prints[r["doc_id"]] for r in found)
    of = {r["doc_id"]: r["component_id"] for r in found}
    assert of[2] == 1 and of[4] == of[5] == of[6] == 4
    assert simhash.simhash_components(none).count() == 0


@pytest.mark.parametrize("run", [2, 64])
def test_links_of_long_runs_connect_the_same(spark, monkeypatch, run):
    monkeypatch.setattr(simhash, "RUN", run)
    r = random.Random(3)
    values = {0} | {sum(1 << b for b in r.sample(range(64), r.randint(1, 4))) for _ in range(60)} | {1 << i for i in range(10)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    nodes = spark.createDataFrame(list(enumerate(values)), "node long, fingerprint long")
    found = {x["node"]: x["component"] for x in components(simhash.links(nodes)).collect()}
    up = list(range(len(values)))
    for _ in values:
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                    up[j] = min(up[i], up[j])
    assert [found.get(i, i) for i in range(len(values))] == up


def test_near_duplicates_keep_one_of_each_group(spark, none):
    base = [f"w{i}" for i in random.Random(1).sample(range(10**6), 300)]
    near = base[:100] + ["new"] + base[101:]
    far = base[:150] + [f"z{i}" for i in range(150)]
    texts = [(3, " ".join(base)), (1, " ".join(near)), (2, " ".join(far)), (5, " ".join(base)), (5, " ".join(base)), (6, None), (7, ""), (8, "one two"), (9, "one TWO")]
    got = near_documents.drop_near_duplicates(spark.createDataFrame([(*t, "en", 0) for t in texts], DOCS))
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 2, 6, 8]
    assert near_documents.drop_near_duplicates(none).count() == 0


def _edited(words, share, r):
    """The words with the single ones at random places replaced by new ones, up to share."""
    out = list(words)
    for i in r.sample(range(len(out)), round(share * len(out))):
        out[i] = f"x{r.randrange(10**9)}"
    return out


def _kept_by_brute_force(texts, size=5, similarity=0.8):
    sets = {i: {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} for i, w in texts.items()}
    lead = {i: i for i in sets}

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and (common := len(sets[a] & sets[b])) >= similarity * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(a), top(b)
                lead[max(x, y)] = min(x, y)
    return sorted(i for i in lead if top(i) == i)


def test_near_duplicates_of_one_original_are_one_group(spark):
    r = random.Random(7)
    texts = {}
    for base, copies in ((1000, 60), (2000, 300)):
        original = [f"w{r.randrange(10**6)}" for _ in range(300)]
        for i in range(copies):
            texts[base + i] = _edited(original, 0.02, r)
        texts[base + copies // 2] = original
    docs = spark.createDataFrame([(i, " ".join(w), "en", 0) for i, w in texts.items()], DOCS)
    got = sorted(x["doc_id"] for x in near_documents.drop_near_duplicates(docs).collect())
    assert got == _kept_by_brute_force(texts) and len(got) < 20


def test_rows_without_an_id_or_with_one_id_keep_their_texts(spark):
    texts = [(None, "one two"), (None, "three four"), (None, "three four"), (4, "five six"), (4, "seven eight"), (4, "seven eight"), (5, "ONE two")]
    got = near_documents.drop_near_duplicates(spark.createDataFrame([(*t, "en", 0) for t in texts], DOCS)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, "one two"), (0, "three four"), (4, "five six"), (4, "seven eight")]


def test_near_duplicates_keep_columns_of_any_name(spark):
    names = ["doc_id", "text", "node", "id", "id_", "node_", "key", "row", "n", "a b.c"]
    rows = [(i, t, *[f"{c}{i}" for c in names[2:]]) for i, t in ((3, "x y z"), (1, "x y z"), (2, None), (1, "x y z"))]
    docs = spark.createDataFrame(rows, names).repartition(3)
    got = near_documents.drop_near_duplicates(docs)
    assert got.columns == names and sorted(map(tuple, got.collect())) == sorted({rows[1], rows[2]})


def test_near_pairs_of_all_similarities_are_found(spark):
    r = random.Random(8)
    texts = {}
    for i in range(120):
        original = [f"{i}w{int(r.paretovariate(0.6))}" for _ in range(r.choice((6, 40, 400, 1500)))]
        texts[2 * i], texts[2 * i + 1] = original, _edited(original, r.choice((0.005, 0.01, 0.015, 0.02, 0.024, 0.04)), r)
    docs = spark.createDataFrame([(i, " ".join(w), "en", 0) for i, w in texts.items()], DOCS)
    got = sorted(x["doc_id"] for x in near_documents.drop_near_duplicates(docs).collect())
    assert got == _kept_by_brute_force(texts)


def test_quality_base_counts():
    text = "a b c d e f g h\n\na b c d e f g h\na b c d e f g h\n #*x <|>"
    assert quality.base_counts(text) == (26, 30, 5, 2, 24)
    assert quality.base_counts("") == (0, 0, 0, 0, 0)
    assert quality.base_counts("é é\n \n \n")[:4] == (2, 2, 0, 0)


def _base_by_hand(text):
    """The same five counts, letter by letter and line by line."""
    gap = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in text + " ":
        if c in gap:
            words += [word] * bool(word)
            word = ""
        else:
            word += c
    lines, again = [], 0
    for line in text.split("\n"):
        if any(c not in gap for c in line):
            again += line in lines
            lines.append(line)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {i + k for i, run in enumerate(runs) if runs.count(run) > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside)


def test_quality_base_counts_by_hand():
    r = random.Random(2)
    for _ in range(300):
        pieces = [r.choice(["a", "b", "é", "#x", "<|>", "ab", " ", "\n", "\t", "\x0b", "\r\n", "\x85", "\u2028", "\xa0"]) + r.choice(["", " ", " ", "\n"]) for _ in range(r.randrange(90))]
        text = "".join(pieces * r.choice([1, 1, 2]))
        assert quality.base_counts(text) == _base_by_hand(text)


def test_target_counts_leave_others_out(spark):
    docs = spark.createDataFrame([(i if i % 7 else None, f"text {i} " * 5) for i in range(400)] + [(3, "same id, other text")], "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 3 == 0 and 1 or 0) for i in range(400)] + [(3, 1), (None, 1)], "doc_id long, quality int")
    found = quality.ngram_counts(docs, quality.trusted_documents(labels))
    plain = np.zeros_like(found)
    for doc_id, text in docs.collect():
        for i, g in enumerate(quality.grams(text.encode())):
            np.add.at(plain[1, i], g, 1)
            if doc_id is not None and doc_id % 3 == 0:
                np.add.at(plain[0, i], g, 1)
    assert (found == plain).all()


def test_quality_rejects_what_is_unlike_the_trusted(spark, none):
    good = [(i, _words(400, i), "en", 0) for i in range(40)]
    junk = [(100 + i, " ".join(w + "###" for w in _words(100, 50 + i).split()), "en", 0) for i in range(8)]
    docs = spark.createDataFrame([*good, *junk, (200, None, None, None)], DOCS)
    labels = spark.createDataFrame([(i, 1, None) for i in range(30)] + [(None, 1, 0), (0, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(docs, labels).collect()}
    assert all(kept[d] for d, *_ in good) and not any(kept[d] for d, *_ in junk) and not kept[200]
    assert quality.quality(none, labels).count() == 0
    assert quality.quality(docs, labels.limit(0)).where("kept").count() == 48


def test_target_counts_cover_all_trusted_documents(spark):
    docs = spark.range(20_500).select(F.col("id").alias("doc_id"), F.lit("abcdefgh").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    found = quality.ngram_counts(docs, quality.trusted_documents(labels))
    assert (found[0] == found[1]).all() and found[0].sum() > 0


def test_packing_places_every_id_once(docs, none, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    found = packing.pack(docs, BPE).collect()
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t, *_ in rows}
    assert sum(r["length"] for r in found) == sum(len(ids[d]) for d, *_ in rows)
    used = {}
    for r in found:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (r["doc_tokens"], r["ids_crc32"]) == (len(ids[r["doc_id"]]), zlib.crc32(np.array(part, "<u4").tobytes()))
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(none, BPE).count() == 0


def test_a_worker_keeps_one_tokenizer(monkeypatch):
    """Where tiktoken reads the file, the tokenizers library stays unloaded until a text needs it."""
    import tokenizers

    packing._encoder.cache_clear()
    monkeypatch.setattr(tokenizers, "Tokenizer", None)
    assert len(packing.token_ids(["some words"], BPE)[0]) >= 8


def test_memory_is_given_back_after_a_step():
    batches = [pa.record_batch({"a": [1, 2]}), pa.record_batch({"a": [3]})]
    assert list(common.lean_batches(lambda x: x)(iter(batches))) == batches
    assert common.lean(lambda a, b: (a, b), 1, 2) == (1, 2)


def test_packing_patterns_hold_the_histogram():
    histogram = {1024: 3, 700: 5, 324: 4, 200: 40, 1: 100}
    held = {}
    for lengths, count in packing.patterns(histogram):
        assert sum(lengths) <= 1024
        for n in lengths:
            held[n] = held.get(n, 0) + count
    assert held == histogram


@pytest.mark.parametrize("text", ["", " " * 1_200_000, "ab1" * 50_000, "<|endoftext|>" * 3 + "<|endoftext", "a  b\n\n c \x1c! e<|endoftext|> f", "  ", "\n \n x", "don't  I'll\t\tgo 12 ...　x\xa0y"])
def test_ids_are_the_tokenizer_s(text):
    from tokenizers import Tokenizer

    assert np.frombuffer(packing.token_ids([text], BPE)[0], "<u4").tolist() == Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


def test_pieces_equal_the_library_s():
    from sentencepiece import SentencePieceProcessor

    library, fst, r = SentencePieceProcessor(model_file=PIECES), sentencepiece_fst.Transducer(PIECES), random.Random(1)
    for _ in range(2000):
        text = "".join(r.choice("aabtheing    \n\t,.!é𝔘日$#1") for _ in range(r.randint(0, 16)))
        ids = fst.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)
        assert fst.decode(ids) == text


def test_round_trip_of_awkward_rows(docs, none, rows):
    found = sentencepiece_fst.round_trip(docs, PIECES).collect()
    assert len(found) == len(rows) and all(r["same"] for r in found)
    assert sentencepiece_fst.round_trip(none, PIECES).count() == 0
    assert sentencepiece_fst.encode(docs, PIECES).where("length(ids) = 0").count() == 2


def test_personal_data(spark, none):
    text = 'a@b.c+d@e.f x..y@z é𝔘 1.2.3.4.5.6.7.8 256.1.1.1 card 4111 1111 1111 1111 and +1 (222) 333-4444 +12345678 "' + "7" * 30
    docs = spark.createDataFrame([(1, text, "en", 0), (1, text, "en", 0), (2, None, "en", 0), (3, "", None, None), (4, "nothing", "en", 0)], DOCS)
    found = pii.find_pii(docs).select("doc_id", "base", pii.redacted().alias("red")).collect()
    assert len(found) == 5
    spans = [(b["kind"], text[b["s"] : b["e"]]) for b in found[0]["base"]]
    assert spans == [("email", "a@b.c"), ("email", "+d@e.f"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (222) 333-4444")]
    assert "4111" not in found[0]["red"] and {r["doc_id"]: r["red"] for r in found}[4] == "nothing"
    assert {r["doc_id"]: r["red"] for r in found}[2] is None
    assert pii.find_pii(none).count() == 0


def test_what_follows_a_cue_word_is_personal(spark):
    r = random.Random(3)
    secrets = {i: "".join(r.choice("0123456789abcdef") for _ in range(39)) + "7" for i in range(60)}
    plain = {i: str(r.randrange(10**15, 10**16)) for i in range(100, 400)}
    plain = {i: n for i, n in plain.items() if sum(sum(divmod(int(c) * (2 - k % 2), 10)) for k, c in enumerate(n)) % 10}
    texts = {i: f'some words token = "{x}" go on' for i, x in secrets.items()} | {i: f"some words {x} go on" for i, x in plain.items()}
    docs = spark.createDataFrame([(i, t, "en", 0) for i, t in texts.items()], DOCS)
    found = {x["doc_id"]: x["red"] for x in pii.find_pii(docs).select("doc_id", pii.redacted().alias("red")).collect()}
    assert all(found[i] == 'some words token = "[TOKEN]" go on' for i in secrets)
    assert all(found[i] == texts[i] for i in plain)


def test_trees_and_their_sql_agree(spark):
    r = np.random.default_rng(0)
    x = r.integers(0, 9, (400, 2)).astype(float)
    y = (x[:, 0] > 4).astype(float)
    model = boosting.fit_trees(x, y)
    p = boosting.predict(model, x)
    assert ((p > 0.5) == y).all()
    df = spark.createDataFrame([(float(a), float(b), float(q)) for (a, b), q in zip(x, p, strict=True)], "a double, b double, p double")
    assert df.where(F.abs(F.expr(boosting.as_sql(model, ["a", "b"])) - F.col("p")) > 1e-9).count() == 0


def _plain_spans(text):
    """Base spans by Python's own regular expressions."""
    digits = lambda t: re.sub("[^0-9]", "", t)

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 12 <= len(digits(t)) <= 19 and luhn(digits(t))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15),
    ]
    return sorted((m.start(), k, m.end(), name) for k, (name, p, fine) in enumerate(kinds) for m in re.finditer(p, text) if fine(m[0]))


def test_personal_data_by_plain_rules(spark):
    r = random.Random(9)
    bits = ["a@b.co", "x.y+z@host-1.example.org", "10.0.0.1", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-45-67", "+1", "é", "@", ".", " ", "-", "7", "word", "00012", "\n"]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", " "]) for _ in range(r.randrange(60))) for _ in range(150)] + ["", None, "1.1.1.1 " * 700, "a@b.co" * 300]
    docs = spark.createDataFrame([(i, t, "p", "q", 3) for i, t in enumerate(texts)], "doc_id long, text string, proposed string, pii_text string, own int")
    found = pii.find_pii(docs)
    assert found.columns == [*docs.columns, "base", "spans"]
    for row in found.select("*", pii.redacted().alias("clean")).collect():
        assert [(x["s"], x["k"], x["e"], x["kind"]) for x in row["base"]] == _plain_spans(row["text"] or "")
        assert (row["proposed"], row["pii_text"], row["own"], row["text"]) == ("p", "q", 3, texts[row["doc_id"]])
        at, out = 0, []
        for x in row["spans"]:
            if x["s"] >= at:
                out += [row["text"][at : x["s"]], f"[{x['kind'].upper()}]"]
            at = max(at, x["e"])
        assert row["clean"] == (None if row["text"] is None else "".join(out) + row["text"][at:])


def test_a_hundred_thousand_matches_take_seconds(spark):
    started = time.perf_counter()
    row = spark.createDataFrame([("1.1.1.1 " * 100_000,)], "text string").select(F.size(pii.base_spans()).alias("n")).first()
    assert row["n"] == 100_000 and time.perf_counter() - started < 30


def test_chat_round_trip(spark):
    turns = [(1, 1, "assistant", "b<|im_end|>\\"), (1, 0, "user", "a\\n<|"), (1, 0, "user", "a\\n<|"), (2, 0, None, None), (2, None, "as\nsistant", "x"), (None, 0, "assistant", "é")]
    found = {r["conv_id"]: r for r in chat.read_conversations(chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))).collect()}
    digest = lambda own: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
    assert found[1]["turns_sha256"] == digest([("user", "a\\n<|"), ("user", "a\\n<|"), ("assistant", "b<|im_end|>\\")])
    assert found[2]["turns_sha256"] == digest([("as\nsistant", "x"), ("", "")])
    assert (found[1]["loss_chars"], found[None]["loss_chars"], found[2]["loss_chars"]) == (len("b<|im_end|>\\"), 1, 0)
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_template_language():
    run = lambda source, **names: _render(source, names)
    assert run("{% for x in xs %}[{{ x.a ~ 1 }}]{% endfor %}", xs=[{"a": "p"}, {"a": None}]) == "[p1][1]"
    assert run("{% if a and not b %}x{% elif b == 'q' %}y{% else %}z{% endif %}", a=1, b="q") == "y"
    assert run("a  {%- set k = 'v' | upper -%}  {{ k }}") == "aV"
    assert template.fold(template.parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}d{% endif %}")) == (template.Out(template.Const("abc")),)
    for bad in ("{% if a %}", "{{ a( }}", "{% call x %}", "{{ a.b.c }}"):
        with pytest.raises(template.TemplateError):
            run(bad, a={"b": "text"})


def _render(source, names):
    return "".join(text for text, _ in template.compile_template(source)(names))


def test_templates_render_whole_conversations(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "assistant", "d")], "conv_id long, turn long, role string, text string")
    source = "<s>{% for m in messages %}[{% if m.role == 'assistant' %}{% generation %}{{ m.text }}{% endgeneration %}{% else %}{{ m.text }}{% endif %}]{% endfor %}</s>"
    parts = sorted(tuple(r) for r in chat.format_conversations(turns, source).collect())
    assert parts == [(1, 0, "<s>[a]", [], []), (1, 1, "[b]", [1], [2]), (1, 2, "[c]</s>", [], []), (2, 0, "<s>[d]</s>", [4], [5])]
    with pytest.raises(Exception, match="over the messages once"):
        chat.format_conversations(turns, source + source).collect()
    # Each part is given on before the next turn is read.
    read = []

    def own():
        for i in range(3):
            read.append(i)
            yield 1, "user", f"t{i}"

    given = chat._parts(chat._renderer(source), own())
    assert next(given)[1] == "<s>[t0]" and read == [0, 1]


def test_archives_and_index_give_the_pages_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    big = "<html>" + "x" * 200
    pages = [(5, "http://www.a.com/x?b=1#f", big), (3, "https://a.com/x?b=1", big), (9, None, big), (1, "not a url\r\n", None), (2, "", "small"), (4, "http://b.org", "small"), (4, "http://b.org", "small")]
    pages += [(20 + i, "http://same.net/", f"{big}{i}") for i in range(10)]
    found = sorted(warc.archive(spark.createDataFrame(pages, "page_id long, url string, html string")).collect(), key=lambda r: (r["page_id"], r["payload_bytes"]))
    assert len(found) == len(pages)
    kinds = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in found}
    assert kinds[3] == ("response", None) and kinds[5] == kinds[9] == ("revisit", 3) and kinds[2] == kinds[4] == ("response", None)
    assert all(r["payload_digest"] == hashlib.sha256((html or "").encode()).hexdigest() for r, (_, _, html) in zip(found, sorted(pages, key=lambda p: p[0]), strict=True))
    assert warc.url_key("http://www.a.com:80/x?b=1#f") == "com,a)/x?b=1"
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pii_learns_from_all_documents(spark, monkeypatch):
    """3,600 documents with a candidate each, two thirds of which teach the trees."""
    seen = []
    fit_trees = pii.fit_trees

    def counted(x, y, n=None):
        seen.append((len(y), len(y) if n is None else int(n.sum())))
        return fit_trees(x, y) if n is None else fit_trees(x, y, n)

    monkeypatch.setattr(pii, "fit_trees", counted)
    docs = spark.range(3600).select(F.col("id").alias("doc_id"), F.concat(F.lit("call +49 30 "), (F.col("id") + 1000000).cast("string")).alias("text"))
    pii.find_pii(docs)
    assert seen[0][1] == 2400 and seen[0][0] < 100


def test_trees_of_counted_rows_are_those_of_repeated_ones():
    r = np.random.default_rng(1)
    x, n = r.integers(0, 6, (60, 3)).astype(float), r.integers(1, 9, 60)
    y = (x[:, 0] + r.integers(0, 3, 60) > 4).astype(float)
    whole = boosting.predict(boosting.fit_trees(np.repeat(x, n, axis=0), np.repeat(y, n)), x)
    assert np.allclose(boosting.predict(boosting.fit_trees(x, y, n), x), whole)


def test_graph_search_recall_and_ties(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 12)).astype(np.float32)
    x[300:420] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1100, [0.0] * 12), (1200, [float("nan")] * 12), (1300, [None] * 12)]
    found = graph_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=50, k=10).collect()
    hit = total = 0
    for q in range(0, 600, 50):
        dist = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(600), dist)) if i != q][:10]
        own = sorted((f["rank"], f["vec_id"], f["score"]) for f in found if f["query_id"] == q)
        assert [f[0] for f in own] == list(range(1, 11))
        assert np.allclose([f[2] for f in own], dist[[f[1] for f in own]], atol=1e-12)
        hit += len({f[1] for f in own} & set(order))
        total += 10
        if q in (0, 300, 350):
            assert [f[1] for f in own] == order
    assert hit / total >= 0.9


@pytest.mark.parametrize("kind", ["norms", "clusters", "huge"])
def test_graph_search_recall_on_other_vectors(spark, kind):
    """Vectors of very different norms, far groups, and squares beyond single precision."""
    r = np.random.default_rng(4)
    x = r.normal(size=(1800, 48))
    x = {"norms": x * np.exp(2 * r.normal(size=(1800, 1))), "clusters": x + 50 * r.normal(size=(9, 48))[r.integers(0, 9, 1800)], "huge": x * 1e25}[kind]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict = {}
    for f in graph_search.nearest(rows, every=30, k=10).collect():
        found.setdefault(f["query_id"], set()).add(f["vec_id"])
    hit = 0
    for q in range(0, 1800, 30):
        dist = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        hit += len(found.get(q, set()) & set([i for i in np.argsort(dist) if i != q][:10]))
    assert hit / 600 >= 0.95


def test_building_a_graph_computes_each_distance_once(monkeypatch):
    """The distances of a shard are a table, equal to those of the vectors; a shard beyond
    its limit, which reads vectors, gets a graph as good."""
    r = np.random.default_rng(6)
    x = r.normal(size=(700, 24)) * np.exp(r.normal(size=(700, 1)))
    own, ids = np.arange(300, 500), r.integers(-1, 700, (200, 40)).astype(np.int32)
    ids[0, 0] = -1
    plain = graph_search._squares(x, ids, x[own])
    assert np.allclose(graph_search._between(x)(own, ids), plain, rtol=1e-5)
    first = graph_search._between(x)(np.array([0]), np.array([[-1, 0, 1]]))[0]
    assert first[0] == np.inf and first[1] < 1e-9 and np.isclose(first[2], ((x[0] - x[1]) ** 2).sum(), rtol=1e-5)

    def recall(graph, start):
        found, _, _ = graph_search.beam_search(lambda rows, ids: graph_search._squares(x, ids, x[rows]), graph, start, 60, 128)
        return np.mean([len(set(found[i, :10]) & set(np.argsort(((x - x[i]) ** 2).sum(axis=1))[:10])) / 10 for i in range(60)])

    monkeypatch.setattr(graph_search, "TABLE_ROWS", 100)
    assert recall(*graph_search.build_graph(x)) >= 0.97
    monkeypatch.undo()
    read = graph_search._squares
    monkeypatch.setattr(graph_search, "_squares", None)
    built = graph_search.build_graph(x)
    monkeypatch.setattr(graph_search, "_squares", read)
    assert recall(*built) >= 0.97


def test_toxicity_learns_held_out_words(spark, none):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(900):
        words = [f"w{r.randint(0, 300)}" for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(2):
                words.insert(r.randint(0, 30), r.choice(["vile", "awful", "nasty"]))
        rows.append((i, " ".join(words), "en" if i % 2 else None, 0))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame([*rows, (5000, None, "en", 0), (5001, "", None, 0)], DOCS)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(docs, known).collect()
    apart = [x for x in found if x["held_out"] and x["doc_id"] < 900]
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1) for x in found)
    assert np.mean([x["predicted"] == (x["doc_id"] % 3 == 0) for x in apart]) > 0.95
    assert all(0 <= x["score"] <= 1 for x in found) and len(found) == 902
    assert toxicity.toxicity(none, known).count() == 0


def test_toxicity_learns_from_every_labelled_document(spark):
    """However many documents there are, and with their shards apart: a word that a few of
    the last ones alone have is learned as well."""
    r = random.Random(5)
    rows, labels = [], []
    for i in range(2_000):
        toxic = i % 4 == 0
        words = r.choices([f"word{k}" for k in range(200)], k=12) + [("vile" if i % 8 else "nasty") if toxic else "kind"]
        rows.append((i, " ".join(words), "en", 0))
        labels.append((i, 1, int(toxic)))
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    read = toxicity._labelled(docs, known.selectExpr("doc_id AS id", "toxic = 1 AS toxic"), 4)
    assert read.rdd.getNumPartitions() == 4 and read.count() == 2_000
    found = toxicity.toxicity(docs, known, shard_docs=300).where("held_out").collect()
    assert np.mean([x["predicted"] == (x["doc_id"] % 4 == 0) for x in found]) > 0.95
    start = toxicity._start(0.3)
    again = toxicity._packed(toxicity._unpacked(toxicity._packed(start)))
    assert np.array_equal(again, toxicity._packed(start))


def test_toxicity_learns_from_labelled_texts_without_words(spark):
    r = random.Random(3)
    rows = [(i, r.choice([None, "", "#$% !", "one"]) if i % 4 else "vile vile", "en", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    found = {x["doc_id"]: x["score"] for x in toxicity.toxicity(docs, known, shard_docs=200).collect()}
    assert len(found) == 600 and min(s for i, s in found.items() if i % 4 == 0) > max(s for i, s in found.items() if i % 4)
    for text in ("", "?!"):
        assert toxicity.word_ids(text).tolist() == [toxicity.PAD] * max(toxicity.WIDTHS)
    assert toxicity.word_ids("one two").size == 4
