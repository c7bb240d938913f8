"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib
import itertools
import math
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from conftest_llm import brute, near
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    bpe, language_id, link_trust, lm_scoring, minhash, mixing, near_vectors, personal_data, queries, suffix_dedup, top_k,
)
from tidemark.llm.blocks import packed, unpacked
from tidemark.llm.common import remainder

EN = "The quick brown fox jumps over the lazy dog while seven cats watch from the garden wall and nobody says a word"
DE = "Der schnelle braune Fuchs springt über den faulen Hund, während sieben Katzen von der Mauer zusehen und schweigen"
LONG = " ".join(f"word{k % 977} number{k % 1013}" for k in range(20_000))


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.load(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


# --- byte-level BPE


def test_bpe_rows(documents, vocabulary):
    df = documents((1, None), (2, ""), (3, "a  b\n c"), (3, "a  b\n c"), (None, "x" * 5000), (4, LONG))
    rows = df.withColumn("ids", bpe.encode(F.col("text"), vocabulary)).withColumn("back", bpe.decode(F.col("ids"), vocabulary))
    found = rows.select("doc_id", "text", "ids", "back").collect()
    assert len(found) == 6
    for r in found:
        assert bytes(r["back"]) == (r["text"] or "").encode()
        assert bool(r["ids"]) == bool(r["text"])


def test_bpe_empty_table(documents, vocabulary):
    assert documents().select(bpe.encode(F.col("text"), vocabulary)).collect() == []


def test_bpe_unknown_id(spark, vocabulary):
    with pytest.raises(Exception, match="not in the vocabulary"):
        spark.sql("SELECT array(1, 99999999) AS ids").select(bpe.decode(F.col("ids"), vocabulary)).collect()


def test_bpe_edits(vocabulary):
    rnd, v = random.Random(5), bpe.Vocabulary.restored(vocabulary.value)
    pieces = ["a", "the", " ", "  ", "\n", "é", "123", "'s", "!?", "漢", "🙂", "    ", "\r\n", "ing"]
    for _ in range(300):
        text = "".join(rnd.choices(pieces, k=rnd.randint(0, 12)))
        edited = bpe.EncodedText(v, text)
        for _ in range(3):
            a, new = rnd.randint(0, len(text)), "".join(rnd.choices(pieces, k=rnd.randint(0, 3)))
            b = rnd.randint(a, len(text))
            edited.replace(a, b, new)
            text = text[:a] + new + text[b:]
            assert edited.ids() == bpe.EncodedText(v, text).ids() == bpe.Encoder(v).encode(text)
        edited.append("ing the")
        assert edited.ids() == bpe.Encoder(v).encode(text + "ing the")
        prefixes = bpe.Prefixes(v, text.encode())
        prefixes.append(b" more")
        assert prefixes.last == bpe.Prefixes(v, text.encode() + b" more").last
    few = bpe.Prefixes(v, b"abc" * 2000)
    assert few.replace(3000, 3001, b"x") < 200
    assert few.last == bpe.Prefixes(v, b"abc" * 1000 + b"xbc" + b"abc" * 999).last


# --- personal data


def test_personal_data_rows(documents):
    tricky = (
        "mail a@b.c_d@e.fg x@y 1.2.3.4.5 999.1.1.1 001.2.3.255 or 4111 1111 1111 1111 or 4111-1111-1111-1112 or 5 "
        "+1 (555) 010-9999 +12 +123 é🙂+49 30 1234567. 12345678901234567890 or 4012888888881881"
    )
    texts = [None, "", tricky, tricky, "9" * 40_000, "a" * 40_000 + "@", "1.1 " * 3000 + "q@r.st", EN]
    found = personal_data.find(documents(*enumerate(texts)), personal_data.Model()).select(
        "doc_id", "personal", personal_data.written(F.col("personal.spans")).alias("w"),
        personal_data.redacted(F.col("text"), F.col("personal.spans")).alias("r"),
    ).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r["doc_id"]]
        base = brute.personal(text)
        assert [tuple(s) for s in r["personal"]["base"]] == base
        assert r["personal"]["spans"] == r["personal"]["base"]
        if base and len(text) < 1000:
            assert "4012888888881881" not in r["r"] and "[CARD]" in r["r"]
        elif not base:
            assert r["r"] == text


def test_personal_data_learned(documents):
    """Addresses written out count as found once the corpus shows that such descriptions pass the checks."""
    rows = [(k, f"{EN} card 4{k:03d}1111{k % 10}111 and user{k}@mail{k}.org, ring +1 555 {k:03d} 9999 ok 10.0.{k % 256}.1") for k in range(700)]
    model = personal_data.learn(documents(*rows))
    assert all(np.isfinite(model.threshold[k]) for k in (personal_data.EMAIL, personal_data.IP, personal_data.PHONE))
    found = personal_data.find(documents((1, "see 10.0.300.1 now"), (2, "see 10.0.30.1 now"), (3, EN)), model).collect()
    spans = {r["doc_id"]: (len(r["personal"]["base"]), len(r["personal"]["spans"])) for r in found}
    assert spans[1] == (0, 1) and spans[2] == (1, 1) and spans[3] == (0, 0)


def test_personal_data_loose(documents):
    """Cards with other separators, national phones and addresses written out are added where they are common."""

    def card(k):
        digits = [int(c) for c in f"4{k * 7919 % 10**14:014d}"]
        total = sum(d if j % 2 else 2 * d - 9 * (d > 4) for j, d in enumerate(digits))
        return "".join(map(str, digits)) + str(-total % 10)

    def fours(k, sign):
        return sign.join(card(k)[j:j + 4] for j in range(0, 16, 4))

    def row(k):
        sign = (" ", ".", "/", "-", "  ")[k % 5]
        return f"{EN} card {fours(k, sign)} and user (at) mail{k}{' (dot) ' if k % 2 else '.'}org, or phone 0555 {k:03d} 9999 ok, order 77 {k:03d} 8888 ok"

    model = personal_data.learn(documents(*[(k, row(k)) for k in range(700)]))
    assert all(np.isfinite(model.threshold[k]) for k in (personal_data.CARD, personal_data.EMAIL, personal_data.PHONE))
    parts = [fours(9001, "."), fours(9002, "  "), "user (at) mail7 (dot) org", "0555 123 9999"]
    text = f"{EN} card {parts[0]} and card {parts[1]} and {parts[2]}, or phone {parts[3]} ok, order 77 123 8888 ok"
    found = personal_data.find(documents((1, text), (2, f"{EN} order 77 123 8888 ok")), model).collect()
    spans = {r["doc_id"]: [(text[s["start"]:s["end"]], personal_data.KINDS[s["kind"]]) for s in r["personal"]["spans"]] for r in found}
    assert spans == {1: list(zip(parts, ("card", "card", "email", "phone"))), 2: []}
    assert all(r["personal"]["base"] == [] for r in found)


def test_personal_data_assured(documents):
    """What assures a threshold is one bound at every size, and candidates found before give the same result."""
    n = np.array([1, 20, 60, 1000, 1000])
    bound = personal_data.assured(np.array([1, 20, 60, 1000, 990]), n)
    assert (np.diff(bound[:4]) > 0).all() and (bound < 1).all() and bound[4] < 0.99
    df = documents(*[(k, f"{EN} mail user{k}@mail.org or 10.0.0.{k} or user (at) mail{k}.org") for k in range(150)], (None, None))
    once = personal_data.propose(df)
    model = personal_data.learn(df)
    assert personal_data.learn(once, given="proposed") == model
    assert np.isfinite(model.threshold[personal_data.EMAIL])
    apart = personal_data.find(df, model).select("doc_id", "personal").collect()
    assert personal_data.find(once, model, given="proposed").select("doc_id", "personal").collect() == apart
    assert sum(len(r["personal"]["spans"]) for r in apart) == 3 * 150


def test_personal_data_empty_table(documents):
    df = documents()
    assert personal_data.find(df, personal_data.learn(df)).collect() == []


# --- suffix dedup


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_random(documents, seed):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choices("ab é", k=rnd.randint(40, 90))) for _ in range(6)] + ["a" * 120, "ab" * 60]
    rows = [(rnd.choice([None, *range(12)]), "".join(rnd.choices([*passages, "xyz", "q"], k=rnd.randint(0, 5)))) for _ in range(25)]
    rows += [(3, None), (4, ""), (5, passages[0] * 3), (5, passages[0] * 3), (99, LONG), (100, LONG[200:])]
    found = suffix_dedup.removed(documents(*rows)).collect()
    got = sorted((str(r["id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in found)
    assert got == sorted((str(i), *e) for (i, _), e in zip(rows, brute.cut(rows)))


def test_suffix_dedup_strips(monkeypatch, documents):
    """Anchors that strips cut differently are settled by their bytes."""
    hasher = suffix_dedup.Hasher()
    text = " ".join(random.Random(1).choices(["alpha", "beta", "gamma", "delta", "eps"], k=400)).encode()
    data = np.frombuffer(text + text, np.uint8)
    borders = np.array([0, len(text), 2 * len(text)])
    whole = suffix_dedup.anchors(data, borders, hasher)
    monkeypatch.setattr(suffix_dedup, "STRIP", 300)
    parts = suffix_dedup.anchors(data, borders, hasher)
    assert whole.windows.sum() == parts.windows.sum() == 2 * (len(text) - suffix_dedup.DEPTH + 1)


def test_suffix_dedup_anchors_whatever_the_strips(monkeypatch):
    rnd = random.Random(2)
    texts = ["".join(rnd.choices("ab c", k=rnd.choice([0, 10, 49, 50, 51, 300, 2000]))).encode() for _ in range(30)]
    data, borders = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    hasher = suffix_dedup.Hasher()
    whole = vars(suffix_dedup.anchors(data, borders, hasher))
    for strip in (36, 50, 301):
        monkeypatch.setattr(suffix_dedup, "STRIP", strip)
        parts = vars(suffix_dedup.anchors(data, borders, hasher))
        assert all(np.array_equal(whole[name], parts[name]) for name in whole)


def contexts(count, grams):
    """Contexts of a few grams, of which many differ in a byte; grams lie anywhere in the first window."""
    rnd = np.random.default_rng(count)
    around = rnd.integers(97, 100, (grams, 120), np.uint8)
    gram, windows, ids = rnd.integers(0, grams, count), rnd.integers(1, 36, count), rnd.integers(0, 9, count)
    ahead = windows - 1 + rnd.integers(0, 36 - windows)
    data = [around[g, 40 - a:90 - a + w - 1].copy() for g, a, w in zip(gram, ahead, windows)]
    for k, bytes_ in enumerate(data):
        bytes_[rnd.integers(0, len(bytes_))] += k % 2
    return gram.astype(np.uint64), ids, ahead, windows, data


@pytest.mark.parametrize("at_once", [1, 60, 1 << 19])
def test_suffix_dedup_grams_larger_than_a_sort(monkeypatch, at_once):
    monkeypatch.setattr(suffix_dedup, "SORTED", at_once)
    for count, grams in ((1, 1), (150, 1), (300, 20)):
        gram, ids, ahead, windows, data = contexts(count, grams)
        own = [(g, a - k, d[k:k + 50].tobytes(), i) for g, a, w, d, i in zip(gram, ahead, windows, data, ids) for k in range(w)]
        lowest = {}
        for *key, i in own:
            lowest[tuple(key)] = min(i, lowest.get(tuple(key), i))
        found = suffix_dedup.repeated_windows(gram, ids, ahead, windows, np.concatenate([*data, np.zeros(8, np.uint8)]))
        assert found.tolist() == [lowest[tuple(key)] < i for *key, i in own]


@pytest.mark.parametrize("at_once", [1, 60, 1 << 19])
def test_suffix_dedup_kinds_by_ranges(monkeypatch, at_once):
    monkeypatch.setattr(suffix_dedup, "SORTED", at_once)
    rnd = np.random.default_rng(5)
    names = rnd.integers(0, 1 << suffix_dedup.HASH_BITS, 40).astype(np.uint64)
    asked = [(np.sort(rnd.choice(names, n)), rnd.integers(0, 3, n).astype(np.uint64), rnd.integers(0, 9, n)) for n in (1, 30, 200)]
    rows = [(k, 0, packed(np.diff(g, prepend=np.uint64(0))), packed(a), packed(i)) for k, (g, a, i) in enumerate(asked)]
    found = suffix_dedup.settle(pd.DataFrame(rows, columns=["block", "bucket", "gram", "around", "ids"]))
    every = [x for g, a, i in asked for x in zip(g.tolist(), a.tolist(), i.tolist())]
    for flags, (g, a, i) in zip(found["flags"], asked):
        assert unpacked(flags, np.uint8).tolist() == [
            suffix_dedup.REPEATED * any((g_, a_) == x[:2] and x[2] < i_ for x in every)
            + suffix_dedup.MIXED * any(g_ == x[0] and a_ != x[1] for x in every)
            for g_, a_, i_ in zip(g.tolist(), a.tolist(), i.tolist())
        ]


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_suffix_dedup_memory():
    """A worker's arrays stay small beside an executor: of a block of 4 MB, and of contexts with many or with few grams."""
    data = np.random.default_rng(1).integers(97, 123, 1 << 22, np.uint8)
    hasher = suffix_dedup.Hasher()
    assert peak_mb(lambda: suffix_dedup.anchors(data, np.arange(0, len(data) + 1, 4096), hasher)) < 48
    for grams in (20_000, 2):
        *given, texts = contexts(80_000, grams)
        data = np.concatenate([*texts, np.zeros(8, np.uint8)])
        assert peak_mb(lambda: suffix_dedup.repeated_windows(*given, data)) < 64


def test_suffix_dedup_empty_table(documents):
    assert suffix_dedup.removed(documents()).collect() == []


# --- language-model scores


def test_lm_rows(documents):
    rows = [(k, t) for k, t in enumerate([None, "", EN, EN.upper(), DE, "a", LONG, "  x\ty\r\nz"])] + [(2, EN), (None, EN)]
    learned = [not brute.left_out(i, 7, 2) for i, _ in rows]
    df = documents(*rows)
    found = lm_scoring.score(df, remainder(F.col("doc_id"), 7) != 2).collect()
    want = sorted((str(i), *e[:3], round(e[3], 6)) for (i, _), e in zip(rows, brute.word_scores(rows, learned)))
    assert sorted((str(r["id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == want
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in found)


def test_lm_probabilities_add_up():
    """After any context the model shares exactly 1 among all bytes."""
    rnd = np.random.default_rng(0)
    byte, counts = np.arange(256), [rnd.integers(0, 40, 256) * rnd.integers(0, 2, 256) for _ in range(5)]
    pairs, tables = np.int64(0x6463 << 8) | byte, [np.zeros(1 << 16, np.int8), np.zeros(1 << 24, np.int8)]
    for table, context, n in zip(tables, (0x63, 0x6463), counts, strict=False):
        table[context << 8:(context + 1) << 8] = lm_scoring.node_table(n[None, :])[0]
    asked = [lm_scoring.path_steps(np.int64(context << 8) | byte, n) for context, n in zip((7, 8, 9), counts[2:], strict=True)]
    x = [*lm_scoring.short_steps(pairs, tables), *(steps for steps, _ in asked)]
    gate = rnd.integers(0, 128, 256).astype(np.uint8)[:, None] * np.zeros(8, np.uint8) + np.arange(8, dtype=np.uint8) * 16
    mixer = lm_scoring.Mixer()
    for _ in range(5):
        mixer.learn(x, gate, byte, np.full(256, 99))
    assert abs((2.0 ** -mixer.bits(x, gate, byte, np.full(256, 99))).sum() - 1) < 1e-9


def test_lm_plain_model(documents):
    """Scores equal those of a model that counts each context's bits in a dictionary, with the weights that blocks began with."""
    rows = [(k, t) for k, t in enumerate([EN, DE, EN.upper(), "a", "", LONG[:3000], "été \U0001f600 x", EN + " " + DE])] + [(None, DE)]
    df = documents(*rows)
    assert df.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(lm_scoring.TUNED)) == 0).isEmpty()
    learned = [not brute.left_out(i, 7, 2) for i, _ in rows]
    want = brute.mixed_bits([t for _, t in rows], learned, lm_scoring.Mixer())
    found = lm_scoring.score(df, remainder(F.col("doc_id"), 7) != 2).collect()
    got = sorted((str(r["id"]), -r["score"] / math.log10(2)) for r in found)
    for (id_, bits), (wanted_id, wanted) in zip(got, sorted((str(i), w) for (i, _), w in zip(rows, want)), strict=True):
        assert id_ == wanted_id and math.isclose(bits, wanted, rel_tol=1e-5)


def test_lm_weights_learn(documents, monkeypatch):
    """Rounds of online steps over several blocks lower the bits of texts that were not learned from."""
    rows = [(k, " ".join(f"word{(k * 37 + j * j) % 211} and {DE.split()[(k + j) % 14]}" for j in range(60))) for k in range(700)]
    df, learn = documents(*rows), remainder(F.col("doc_id"), 7) != 2
    assert df.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(lm_scoring.TUNED)) == 0).count() > 3
    unseen = F.avg(F.when(~F.col("learned"), F.col("bits_per_byte")))
    taught = lm_scoring.score(df.repartition(3), learn).agg(unseen).first()[0]
    monkeypatch.setattr(lm_scoring, "ROUNDS", 0)
    assert taught < 0.99 * lm_scoring.score(df.repartition(3), learn).agg(unseen).first()[0]


def test_lm_all_documents_teach(documents, spark, tmp_path, monkeypatch):
    """The query's weights learn from every training document, so also where none has a hash that stands for one in many."""
    rows = [(k, " ".join(f"word{(k * 37 + j * j) % 211} and {DE.split()[(k + j) % 14]}" for j in range(60))) for k in range(500)]
    df = documents(*rows).filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(lm_scoring.TUNED)) != 0)
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    unseen = F.avg(F.when(F.col("held_out"), F.col("bits_per_byte")))
    taught = queries.QUERIES["op4_lm_scoring"](spark, str(tmp_path)).agg(unseen).first()[0]
    monkeypatch.setattr(lm_scoring, "ROUNDS", 0)
    assert taught < 0.99 * queries.QUERIES["op4_lm_scoring"](spark, str(tmp_path)).agg(unseen).first()[0]


def test_lm_left_out():
    """Steps and levels without a document's own occurrences of a pair are those of plain counts, in tables too."""
    rnd = np.random.default_rng(8)
    keys = np.unique(rnd.integers(0, 40, 900) << 8 | rnd.integers(97, 117, 900))
    counts = rnd.integers(0, 30, len(keys))
    for again in (np.zeros(len(keys), int), rnd.integers(0, counts + 1)):
        steps, levels = lm_scoring.left_steps(keys, counts, again)
        table = lm_scoring.left_table(np.bincount(keys, counts, 40 << 8).astype(np.int64).reshape(-1, 256))
        for key, n, a, step, level in zip(keys.tolist(), counts.tolist(), again.tolist(), steps, levels.tolist(), strict=True):
            left = n if n == a else round(n / (n - a))
            of = lambda bits: sum(m for k, m in zip(keys.tolist(), counts.tolist()) if k >> bits == key >> bits)
            for place in range(8):
                total, taken = of(8 - place), of(7 - place)
                want = math.log((taken - left + lm_scoring.PRIOR) / (total - taken + lm_scoring.PRIOR))
                assert abs(step[place] - max(-127, min(127, lm_scoring.SCALE * want))) < 0.51
                assert level >> 2 * place & 3 == min(3, int(math.log2(total - left + 1) / 2))
                if n and not a:
                    assert step[place] == table[key >> 8, 2 << place | (key & 255) >> 7 - place]


def test_lm_bits_teach_once(monkeypatch):
    """Each different bit is listed once, with all its occurrences, and online steps have all of them."""
    rnd = np.random.default_rng(9)
    x = [rnd.integers(-1, 2, (700, 8)).astype(np.int8) for _ in range(2)]
    gate, pairs, times = rnd.integers(0, 2, (700, 8)).astype(np.uint8), rnd.integers(97, 100, 700) << 8 | rnd.integers(0, 256, 700), rnd.integers(1, 9, 700)
    bits, often = lm_scoring.same_bits(x, gate, pairs, times)
    want = Counter()
    for place, k in itertools.product(range(8), range(700)):
        want[pairs[k] >> 8 & 255, gate[k, place] << 1 | pairs[k] >> 7 - place & 1, *(s[k, place] for s in x), place] += times[k]
    got = Counter()
    for row, n in zip(bits.view(np.uint8).reshape(-1, 8), often.tolist(), strict=True):
        got[row[5], row[6], *row[4:2:-1].view(np.int8)] += n
    merged = Counter()
    for key, n in want.items():
        merged[key[:-1]] += n
    assert got == merged and len(bits) == len(want) < 5600
    for pieces in (500, 1 << 19):
        monkeypatch.setattr(lm_scoring, "PIECES", pieces)
        order, share, steps = lm_scoring.dealt(often)
        assert np.allclose(np.bincount(order, share, len(often)), often) and share.max() <= max(1, often.sum() / pieces) + 1e-6
        assert [k for own in steps for k in range(own.start, own.stop)] == list(range(len(order)))


def test_lm_units(monkeypatch):
    """Pairs, their counts and the bytes' order are those of plain loops over the bytes, also if parts are cut within documents."""
    rnd = np.random.default_rng(5)
    odd = [None, "", "a", "ab", "abc", "abcd", "a b c", "ab cd ab", "\0 \0a \0\0ab ab", "\0ab", "été \U0001f600 x", "x" * 40, EN, " y\tz\n"]
    odd += [" ".join("".join(rnd.choice(list("ab\0é"), n)) for n in rnd.integers(1, 7, 20)) for _ in range(20)]
    lines = [lm_scoring.words_and_end(t) for t in odd]
    roles, sizes = np.arange(len(lines)) % 3, np.array([len(x) for x in lines])
    assert lm_scoring.Words(lm_scoring.words_packed(lines)).lines() == lines
    for part in (lm_scoring.PART, 100):
        monkeypatch.setattr(lm_scoring, "PART", part)
        for wanted in (None, roles == 2):
            own = [x for i, x in enumerate(lines) if wanted is None or wanted[i]]
            units = [u for _, u in lm_scoring.units(lm_scoring.Words(lm_scoring.words_packed(own)), sizes, roles, wanted)]
            assert (len(units) > 1) == (part == 100)
            assert b"".join(u.byte[u.places()].astype(np.uint8).tobytes() for u in units) == b"".join(own)
            for k, width in enumerate((3, 4)):
                for role in (1, 2):
                    want, got = Counter(), Counter()
                    for line, r in zip(lines, roles, strict=True):
                        if r == role and (wanted is None or r == 2):
                            before = bytes(width) + line
                            want.update(int.from_bytes(before[i:i + width + 1], "big") for i in range(len(line)))
                    for u in units:
                        n = np.bincount(u.at[k], u.times[role - 1], len(u.keys[k])).astype(int)
                        got.update({int(key): int(m) for key, m in zip(u.keys[k], n, strict=True) if m})
                    assert got == want
            for role in (1, 2):
                want = Counter(
                    (bytes(word[:i]), word[i]) for line, r in zip(lines, roles, strict=True) if r == role and (wanted is None or r == 2)
                    for word in re.findall(rb"[^ \n]*[ \n]", line) for i in range(len(word))
                )
                got = Counter()
                for u in units:
                    n = np.bincount(u.at[2], u.times[role - 1], len(u.keys[2])).astype(int)
                    got.update({int(key): int(m) for key, m in zip(u.keys[2], n, strict=True) if m})
                assert sorted(got.values()) == sorted(want.values())


def test_lm_replies_take_little(documents, monkeypatch):
    """Replies come back as they were; all of them take less than three bytes for a byte of this text, where they took 3.7."""
    rnd = np.random.default_rng(6)
    keys = np.unique(rnd.integers(0, 3000, 20000) << 8 | rnd.integers(97, 123, 20000))
    steps, levels = lm_scoring.path_steps(keys, rnd.integers(0, 50, len(keys)))
    offsets = np.array([0, 0, 700, 701, len(keys)])
    rows = list(lm_scoring.coded(keys, steps, levels, offsets))
    found = lm_scoring.decoded(keys, offsets, rows)
    assert (found[0] == steps).all() and (found[1] == levels).all()
    words = ["".join(rnd.choice(list("etaoinshrdlu"), n)) for n in rnd.integers(2, 9, 4000)]
    rows = [(k, " ".join(rnd.choice(words, 400))) for k in range(60)]
    kept, stored = {}, lm_scoring.stored
    monkeypatch.setattr(lm_scoring, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    df = documents(*rows).repartition(2)
    assert lm_scoring.score(df, remainder(F.col("doc_id"), 7) != 2).count() == 60
    bytes_ = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("steps", "levels", "tuned_steps", "tuned_levels"))
    taken = kept["predictions"].agg(F.sum(bytes_)).first()[0]
    assert taken < 3 * sum(len(t) for _, t in rows)


def test_lm_nothing_learned(documents):
    found = lm_scoring.score(documents((1, EN), (2, None)), F.lit(False)).collect()
    assert {r["train_tokens"] for r in found} == {0} and {r["n_known"] for r in found} == {0}
    assert lm_scoring.score(documents(), F.lit(True)).collect() == []


# --- link trust

RULES = (("allow", "good.org/"), ("block", "bad.org/"), ("allow", "bad.org/ok/"))


def pages(spark, *rows):
    return spark.createDataFrame([(k, u, h, "x") for k, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string")


def test_link_trust(spark):
    link = '<a href="{}">'.format
    rows = [
        ("https://good.org/x", link("http://friend.net/a") + link("/own")), ("https://WWW.bad.org/en/", None), ("ftp://bad.org/ok/1?q", ""),
        ("http://spam.net/", link("//www.bad.org/q") * 5 + link("http://good.org:80/")), ("http://friend.net/p", link("https://good.org/")),
        ("http://lonely.net/", "<p>"), (None, link("http://good.org/")), ("no host", None), ("http://good.org", None), ("http://good.org/x", None),
        ("http://xgood.org/", None),
    ]
    found = by_id(link_trust.verdicts(pages(spark, *rows), RULES), "page_id")
    assert len(found) == len(rows)
    for k, (url, _) in enumerate(rows):
        host, path, rule, verdict = brute.judge(url, [(v, r) for v, r in RULES])
        judged = found[k]["judged"]
        assert (judged["host"], judged["path"], judged["rule"]) == (host, path, rule)
        if rule:
            assert judged["verdict"] == verdict
    assert found[3]["judged"]["verdict"] == "block" and found[4]["judged"]["verdict"] == "allow"
    assert {found[k]["judged"]["verdict"] for k in (5, 7, 8)} == {"allow"}
    assert link_trust.verdicts(pages(spark, (None, None)).limit(0), RULES).collect() == []


def ranks_by_loops(hosts, weight, good, bad):
    """Trust and distrust by plain loops over hosts and weighted edges."""

    def rank(edges, seed):
        out = {h: sum(x for (a, _), x in edges.items() if a == h) for h in hosts}
        into = {h: [(s, w / out[s]) for (s, d), w in edges.items() if d == h and s in out] for h in hosts}
        now = {h: float(h == seed) for h in hosts}
        for _ in range(link_trust.ROUNDS):
            now = {h: 0.15 * (h == seed) + 0.85 * sum(now[s] * w for s, w in into[h]) for h in hosts}
        return now

    return rank(weight, good), rank({(b, a): w for (a, b), w in weight.items()}, bad)


def test_link_trust_ring_and_chain(spark):
    """Fifty hosts in a ring with both seeds, and a chain: rounds end, and plans stay small."""
    ring = [f"r{k}.net" for k in range(48)] + ["good.org", "bad.org"]
    chain = [f"c{k}.net" for k in range(30)]
    rows = [(f"http://{h}/", f'<a href="http://{o}/z">') for h, o in zip(ring, ring[1:] + ring[:1])]
    rows += [(f"http://{h}/", f'<a href="http://{o}/z"><a href="http://nowhere.net/">') for h, o in zip(chain, chain[1:] + ["bad.org"])]
    began = time.monotonic()
    found = by_id(link_trust.verdicts(pages(spark, *rows), RULES), "page_id")
    assert time.monotonic() - began < 120
    hosts = ring + chain
    weight = {(h, o): 1 for h, o in zip(ring, ring[1:] + ring[:1])}
    weight |= {(h, o): 1 for h, o in zip(chain, chain[1:] + ["bad.org"])} | {(h, "nowhere.net"): 1 for h in chain}
    trust, distrust = ranks_by_loops(hosts, weight, "good.org", "bad.org")
    for r in found.values():
        h = r["judged"]["host"]
        assert r["judged"]["trust"] == pytest.approx(trust[h], rel=1e-6, abs=1e-30)
        assert r["judged"]["distrust"] == pytest.approx(distrust[h], rel=1e-6, abs=1e-30)
    hosts = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "host string, seed double")
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "src string, dst string, share double")
    ranks = link_trust.propagate(hosts, [("seed", "rank", edges)])
    assert ranks._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 64


def test_link_trust_ranks(spark):
    """Against the same sums in plain loops."""
    rnd = random.Random(3)
    hosts = [f"h{k}.net" for k in range(8)] + ["good.org", "bad.org"]
    rows = [(f"http://{h}/", "".join(f'<a href="http://{o}/z">' for o in rnd.choices(hosts, k=4))) for h in hosts for _ in range(2)]
    found = by_id(link_trust.verdicts(pages(spark, *rows), RULES), "page_id")
    weight = {}
    for (u, h) in rows:
        src = u[7:-1]
        for o in hosts:
            if o != src and (n := h.count(f"//{o}/")):
                weight[src, o] = weight.get((src, o), 0) + n

    def rank(edges, seed):
        base = {h: float(h == seed) for h in hosts}
        now = dict(base)
        for _ in range(link_trust.ROUNDS):
            now = {h: 0.15 * base[h] + 0.85 * sum(
                now[s] * w / sum(x for (a, _), x in edges.items() if a == s) for (s, d), w in edges.items() if d == h
            ) for h in hosts}
        return now

    trust, distrust = rank(weight, "good.org"), rank({(b, a): w for (a, b), w in weight.items()}, "bad.org")
    for r in found.values():
        h = r["judged"]["host"]
        assert abs(r["judged"]["trust"] - trust[h]) < 1e-8 and abs(r["judged"]["distrust"] - distrust[h]) < 1e-8


def test_link_trust_small_shares(spark):
    """A host's verdict doesn't hang on how many other hosts have seeds."""
    html = "".join(f'<a href="http://{h}/">' for h in ("one.bad.org", *(f"f{k}.net" for k in range(299))))
    few = [("http://spam.net/", html), ("http://one.bad.org/", None), *((f"http://f{k}.net/", None) for k in range(299))]
    many = spark.range(200_000).selectExpr("id + 1000 AS page_id", "concat('http://h', id, '.bad.org/') AS url",
                                           "CAST(NULL AS string) AS html", "'x' AS host")
    for rows in (pages(spark, *few), pages(spark, *few).union(many)):
        judged = link_trust.verdicts(rows, RULES).filter("page_id = 0").first()["judged"]
        assert judged["verdict"] == "block" and judged["distrust"] > 0


def test_link_trust_chain(spark):
    """Distrust comes over more than a dozen hosts."""
    rows = [(f"http://c{k}.net/", f'<a href="http://c{k + 1}.net/">') for k in range(20)]
    rows += [("http://c20.net/", '<a href="http://bad.org/">'), ("http://bad.org/", None)]
    found = by_id(link_trust.verdicts(pages(spark, *rows), RULES), "page_id")
    assert {found[k]["judged"]["verdict"] for k in range(21)} == {"block"}


# --- vectors


def vectors(spark, *rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, component_id string")


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "CELL", 40)
    monkeypatch.setattr(near_vectors, "RESIDENTS", 30)
    monkeypatch.setattr(near_vectors, "VISITORS", 50)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 8))
    data = [(centres[k % 12] + rng.normal(size=8) * 0.25 * (k % 3)).astype(np.float32).tolist() for k in range(300)]
    rows = list(enumerate(data)) + [(300 + k, data[5]) for k in range(20)] + [(400, [2 * x for x in data[7]])]
    plain = {i: np.array(v, np.float64) for i, v in rows}
    odd = [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None] + [0.0] * 6), (504, [float("nan")] * 8), (505, [float("inf")] * 8),
           (506, data[5][:4]), (507, [1e30] * 8), (508, [1e-30] * 8), (5, data[5]), (None, data[5])]
    plain |= {507: np.ones(8), 508: np.ones(8)}
    links = {i: sum(j != i and a @ b >= 0.95 * np.sqrt((a @ a) * (b @ b)) for j, b in plain.items()) for i, a in plain.items()}
    component = brute.reachable(plain, lambda i, j: plain[i] @ plain[j] >= 0.95 * np.sqrt((plain[i] @ plain[i]) * (plain[j] @ plain[j])))
    found = near_vectors.near_vectors(vectors(spark, *rows, *odd)).collect()
    assert len(found) == len({i for i, _ in rows + odd if i is not None})
    for r in found:
        i = r["id"]
        assert (r["n_links"], r["component_id"]) == ((links[i], component[i]) if i in plain else (0, i)), i
    assert near_vectors.near_vectors(vectors(spark, (1, None)).limit(0)).collect() == []


def test_quantised_bounds():
    """No pair at the threshold escapes the bounds, however close."""
    rng = np.random.default_rng(1)
    left = rng.normal(size=(200, 16))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    other = rng.normal(size=left.shape)
    other -= (other * left).sum(1, keepdims=True) * left
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = 0.95 + rng.choice([-1, 1], 200)[:, None] * 10.0 ** -rng.integers(2, 10, 200)[:, None]
    right = cosine * left + np.sqrt(1 - cosine**2) * other
    hits = np.concatenate([part for _, part in near_vectors.linked(left, right, 0.95)])
    assert (hits == (np.einsum("ik,jk->ij", left, right) >= 0.95)).all()


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD", 40)
    monkeypatch.setattr(top_k, "BLOCK", 3)
    rng = np.random.default_rng(2)
    data = {k: np.round(rng.normal(size=20) * 0.3, 1) for k in range(200)}  # many ties
    odd = [(1000, None), (1050, [1.0, None]), (1100, [float("nan")]), (None, [1.0]), (7, data[7].tolist()), (1150, []), (1200, [0.5])]
    found = {}
    table = vectors(spark, *[(k, v.tolist()) for k, v in data.items()], *odd)
    for r in top_k.top_k(table, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {k: np.floor(256 * v.astype(np.float32).astype(np.float64)).astype(np.int64) for k, v in data.items()}
    whole |= {1150: np.zeros(20, np.int64), 1200: np.array([128] + [0] * 19)}
    queries = [k for k in whole if k % 50 == 0]
    assert sorted(found) == sorted(queries)
    for q in queries:
        best = sorted((-int(whole[k] @ whole[q]), k) for k in whole if k != q)[:5]
        assert sorted(found[q]) == [(n + 1, k, -s) for n, (s, k) in enumerate(best)]
    few = top_k.top_k(vectors(spark, (50, [1.0]), (51, [2.0])), F.col("vec_id") % 50 == 0).collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in few] == [(50, 51, 256 * 512)]
    assert top_k.top_k(vectors(spark, (1, None)).limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_large_components(spark, monkeypatch):
    """Components and sums that doubles don't hold, by the same method, with floors from the first shard."""
    monkeypatch.setattr(top_k, "SHARD", 30)
    given = [(0, [1.0, 0.0]), (1, [2.0**24, 0.0]), (2, [0.5, 1.0])]
    found = top_k.top_k(vectors(spark, *given), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found) == [(1, 1, 2**40), (2, 2, 128 * 256)]
    rnd = random.Random(3)
    data = {k: [float(np.float32(rnd.choice([1, 1, 2.0**18, -(2.0**19)]) * rnd.uniform(-8, 8))) for _ in range(6)] for k in range(120)}
    asked = {}
    for r in top_k.top_k(vectors(spark, *data.items()), F.col("vec_id") % 10 == 0, k=4).collect():
        asked.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {k: [math.floor(256 * x) for x in v] for k, v in data.items()}
    for q in range(0, 120, 10):
        scores = {k: sum(a * b for a, b in zip(whole[q], v)) for k, v in whole.items() if k != q}
        best = sorted((-s, k) for k, s in scores.items())[:4]
        assert sorted(asked[q]) == [(n + 1, k, -s) for n, (s, k) in enumerate(best)]
    assert max(abs(s) for _, _, s in asked[0]) > 2**53
    huge = top_k.top_k(vectors(spark, (0, [1e37]), (1, [1e37]), (2, [-1e37])), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in huge) == [(1, 1, 2**63 - 1), (2, 2, -(2**63))]


# --- min-max hashing


@pytest.mark.parametrize("shingle", [2, 5])
def test_minhash(documents, monkeypatch, shingle):
    monkeypatch.setattr(minhash, "GROUP", 3)  # so that buckets are dealt into groups
    rnd, rows = random.Random(shingle), []
    for family in range(12):
        own = rnd.choices([f"w{k}" for k in range(300)], k=rnd.choice([3, 12, 60, 200]))
        for _ in range(10):
            copy = list(own)
            for _ in range(rnd.randint(0, max(1, len(own) // 25))):
                copy[rnd.randrange(len(copy))] = f"n{rnd.random()}"
            rows.append((len(rows) * 7 % 121, " ".join(copy)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, "one two"), (206, LONG), (207, LONG + " end"), (206, LONG)]
    sets = {i: brute.shingles(t, shingle) for i, t in rows}
    component = brute.reachable(sets, lambda a, b: bool(sets[a]) and bool(sets[b]) and near(sets[a], sets[b], 80))
    found = minhash.near_duplicates(documents(*rows, (None, EN), (None, EN)), shingle, 80).collect()
    assert len(found) == len(rows) + 2
    for r in found:
        i = r["id"]
        if i is None:
            assert r["kept"] and r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), component[i], component[i] == i), i
    assert minhash.near_duplicates(documents()).collect() == []


def test_minhash_rows_of_one_id(documents):
    """Different rows that share an id link each with what is like it."""
    one, two, other = (" ".join(f"{k}{n}" for n in range(80)) for k in "abc")
    rows = [(1, one), (2, two), (3, one + " x"), (3, two + " x"), (4, other), (3, other + " y")]
    found = {(r["id"], r["n_shingles"]): r["component_id"] for r in minhash.near_duplicates(documents(*rows), 2, 80).collect()}
    assert set(found.values()) == {1} and len(found) == 4


def test_minhash_likely_among(spark, monkeypatch):
    """The map of bits loses no id, and few others get through while it is far from full."""
    rows = spark.range(-3000, 3000).union(spark.createDataFrame([(2**62,), (None,)], "id long"))
    ids = rows.filter("id % 7 = 0 OR id > 3000")
    left = {r["id"] for r in minhash.likely_among(rows, ids).collect()}
    wanted = {r["id"] for r in ids.collect()}
    assert wanted <= left and len(left - wanted) < 20
    monkeypatch.setattr(minhash, "ID_BITS", 64)
    assert wanted <= {r["id"] for r in minhash.likely_among(rows, ids).collect()}
    assert minhash.likely_among(rows, ids.limit(0)).collect() == []


def test_minhash_marks_that_meet(documents, monkeypatch):
    """Sets of one id whose short marks are equal join each other's buckets; links stay the same."""
    other = " ".join(f"word{k}" for k in range(30))
    df = documents((1, EN), (1, other), (2, f"{EN} again"), (3, f"{other} again"), (4, None))

    def found():
        return sorted((r["id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, 2, 80).collect())

    expected = found()
    hashes = F.hash
    monkeypatch.setattr(minhash.F, "hash", lambda *c: hashes(*c) * 0)
    assert found() == expected and {r[2] for r in expected} == {1, 4}


def test_minhash_tiles(spark, monkeypatch):
    """What tiles find joins exactly the components that plain comparisons of a bucket's members join."""
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(40)]
    texts = [" ".join(w if rnd.random() > 0.06 else f"n{rnd.random()}" for w in base) for _ in range(60)]
    rows = [(k % 3, k, str(k).encode(), 39, k if k % 4 else 0, 0) for k in range(60)]
    open_ = spark.createDataFrame(rows, "bucket long, id long, set binary, n_shingles long, component long, main long")
    given = spark.createDataFrame([(str(k).encode(), t) for k, t in enumerate(texts)], "set binary, text string")
    sets = [brute.shingles(t, 2) for t in texts]
    first = {k: r[4] for k, r in enumerate(rows)}
    same = lambda a, b: near(sets[a], sets[b], 80)
    expected = brute.reachable(range(60), lambda a, b: first[a] == first[b] or (
        a % 3 == b % 3 and (first[a] or first[b]) and same(a, b)))
    for size in (1 << 18, 39 * 128, 500):
        monkeypatch.setattr(minhash, "TILE", size)
        links = [(r["a"], r["b"]) for r in minhash.tiles(open_, given, 2, 80).collect()]
        assert all(same(a, b) and a % 3 == b % 3 for a, b in links)
        found = brute.reachable(range(60), lambda a, b: first[a] == first[b] or (a, b) in links or (b, a) in links)
        assert found == expected and len(set(found.values())) < 45


def test_minhash_recall():
    """Sets of similarity 0.8 share a band as often as they should."""
    rng = np.random.default_rng(4)
    missed = 0
    for _ in range(300):
        both, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (80, 10, 10))
        one, two = (minhash.bands(*minhash.signature(np.append(both, x))) for x in (a, b))
        missed += not (one == two).any()
    assert missed == 0


# --- mixing


def test_mixing(documents):
    rnd = random.Random(6)
    rows = [(k, " ".join(["w"] * rnd.randint(0, 40)), "en", rnd.choice(["a", "a", "a", "b", "Z", "é", None])) for k in range(400)]
    rows += [(1000, None, "en", "a"), (1001, "", "en", "empty"), (None, "x y", "en", "b"), rows[0], rows[0], (1002, "tiny", "en", "0small")]
    size = {s: sum(len(brute.words(t)) for _, t, _, o in rows if o == s) for s in {r[3] for r in rows}}
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, brute.shares([size[s] for s in order], (5, 2, 1))))
    df = documents(*rows)
    found = mixing.copies(df, mixing.balance(df, (5, 2, 1))).select("doc_id", "source", "mix.*").collect()
    assert len(found) == len(rows)
    for s in order:
        own = [r for r in found if r["source"] == s]
        assert {(r["source_size"], round(r["target"], 6)) for r in own} == {(size[s], round(target[s], 6))}
        assert abs(sum(r["copies"] * r["size"] for r in own) - target[s]) <= 40
        assert all(0 <= r["copies"] <= 3 for r in own)
    empty = documents()
    assert mixing.copies(empty, mixing.balance(empty, (5, 2, 1))).collect() == []


def test_mixing_base_rates(documents):
    """With base rates, Newton's steps have to find the multipliers."""
    rows = [(k, "w " * (k % 13 + 1), "en", "ab"[k % 5 == 0]) for k in range(500)]
    base = F.when(F.col("doc_id") % 2 == 0, 0.2).otherwise(1.5)
    df = documents(*rows)
    parameters = mixing.balance(df, (1, 3), base=base)
    found = mixing.copies(df, parameters, base=base).select("source", "mix.*").collect()
    for s in "ab":
        own = [r for r in found if r["source"] == s]
        assert abs(sum(r["rate"] * r["size"] for r in own) / own[0]["target"] - 1) < 1e-6
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) <= 13


# --- language identification


def test_language_id(documents):
    learned = language_id.learn(documents((1, EN, "en"), (2, DE, "de"), (3, None, "fr"), (4, "x", None)))
    assert set(learned) == {"en", "de"}
    texts = [None, "", "123 !?", EN, DE, DE.upper(), "ß", LONG, "\x00", "İstanbul"]
    found = language_id.predict(documents(*enumerate(texts), (3, EN)), learned).select("doc_id", "prediction.*").collect()
    assert len(found) == len(texts) + 1
    said = {r["doc_id"]: r["lang"] for r in found}
    assert [said[k] for k in (0, 1, 2, 3, 4, 5, 8)] == ["und", "und", "und", "en", "de", "de", "und"]
    assert all(0 <= r["score"] <= 1 and (r["lang"] != "und" or r["score"] == 0) for r in found)
    assert language_id.learn(documents()) == {}
    assert {r["prediction"]["lang"] for r in language_id.predict(documents((1, EN)), {}).collect()} == {"und"}


def test_language_profile_counts(documents):
    """Profiles are the most frequent n-grams, counted plainly."""
    text = "Ab, abba! a"
    marked = " ab abba a "
    want = {}
    for n in (1, 2, 3):
        for k in range(len(marked) - n + 1):
            gram = marked[k:k + n]
            if gram.strip() and (n < 3 or gram[1] != " "):
                want[gram] = want.get(gram, 0) + 1
    letters = language_id.letter_table()
    _, grams, counts = language_id.count_grams(np.zeros(1), [text], letters)

    def read(number):
        return "".join(chr(c) for k in (2, 1, 0) if (c := number >> (language_id.BITS * k) & 0x1FFFFF))

    assert {read(g): n for g, n in zip(grams.tolist(), counts.tolist())} == want


# --- pipeline


def test_pipeline(spark, documents, vocabulary):
    rnd = random.Random(8)
    vocab = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    rows = []
    for k in range(120):
        text = " ".join(rnd.choices(vocab, k=60))
        rows.append((k, f"{text} mail{k}@site.org", "en", "ab"[k % 3 == 0]))
        if k % 4 == 0:
            rows.append((500 + k, text + f" mail{k}@site.org", "en", "a"))
    rows += [(900, None, "en", "a"), (901, "", "en", "a"), (902, "123 456", "en", "b"), rows[5], rows[5], (None, EN, "en", None)]
    docs = documents(*rows)
    columns, now = docs.columns, docs
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, ""), "test")
        counts.append(now.count())
        assert name == "tokens" or now.columns == columns
        if name == "language":
            assert {900, 901, 902}.isdisjoint(r["doc_id"] for r in now.collect())
        if name == "near copies":
            left = [r["doc_id"] for r in now.collect()]
            assert sorted(map(str, left)) == sorted(map(str, [*range(120), None]))
        if name == "personal data":
            texts = [(r["doc_id"], r["text"], r["n_chars"]) for r in now.collect()]
            assert not any("@site" in t for _, t, _ in texts) and all(n == len(t) for _, t, n in texts)
            assert all("[EMAIL]" in t for i, t, _ in texts if i is not None)
        if name == "mixing":
            mixed = now.collect()
    tokens = now.collect()
    encoder = bpe.Encoder(bpe.Vocabulary.restored(vocabulary.value))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in tokens) == sorted((str(r["doc_id"]), encoder.encode(r["text"])) for r in mixed)
    assert counts[0] == len(rows) - 3 and counts[1] == counts[2] == 121


def test_pipeline_empty(spark, documents):
    now = documents()
    for _, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, ""), "test")
    assert now.collect() == []
