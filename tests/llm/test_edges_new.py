"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for operators 11 to 13."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers as library
from conftest_llm import brute
from pyspark.sql import functions as F

from tidemark.llm import alignment, quality, whitening

EN = "The quick brown fox jumps over the lazy dog while seven cats watch from the garden wall and nobody says a word"


@pytest.fixture(scope="module")
def both(spark):
    tokenizer = library.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return tokenizer, processor, alignment.load(spark, *paths, public_tokenizers.PATTERN)


def plain(both, texts):
    return brute.aligned(both[0], both[1], texts)


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    rnd = random.Random(7)
    pieces = ["a", "the", " ", "  ", "\n", "é", "é", "12345", "'s", "!?", "漢字", "🙂", "    ", "\r\n", "ing", "<|endoftext|>", "<s>",
              "▁", "<0x41>", "\x00", " ", "ﬁ", "aaa", "www", "\t"]
    return ["".join(rnd.choices(pieces, k=rnd.randint(1, 30))) for _ in range(300)]


def test_alignment_rows(documents, both):
    texts = [None, "", " ", EN, EN, "▁", "<|endoftext|> <s> <unk>", *odd_texts()]
    df = documents(*[(k // 2 if k % 5 else None, t) for k, t in enumerate(texts)])
    rows, linked = alignment.align(df, both[2])
    found = sorted(tuple(r[n] for n in NAMES) + (r["id"] is None,) for r in rows.collect())
    assert found == sorted(e + (k % 5 == 0,) for k, e in enumerate(plain(both, texts)))
    times = linked.collect()
    assert len({r["pair"] for r in times}) == len(times) and sum(r["count"] for r in times) == sum(f[3] for f in found)
    for b in {r["second"] for r in times}:
        top = max(r["count"] for r in times if r["second"] == b)
        assert all(r["best"] == (r["count"] == top) for r in times if r["second"] == b)


def test_alignment_parts(documents, both, monkeypatch):
    """Texts cut into segments and blocks give what whole ones give."""
    texts = [" ".join(f"word{k % 37} number{k % 53}," for k in range(3000)), "x" * 5000, "a b " * 2000 + "▁", EN * 40, *odd_texts()[:40]]
    df = documents(*enumerate(texts))
    monkeypatch.setattr(alignment, "SEGMENT", 700)
    monkeypatch.setattr(alignment, "BLOCK", 2000)
    rows, _ = alignment.align(df, both[2])
    found = {r["id"]: tuple(r[n] for n in NAMES) for r in rows.collect()}
    assert found == dict(enumerate(plain(both, texts)))


def test_alignment_empty_table(documents, both):
    rows, linked = alignment.align(documents(), both[2])
    assert rows.collect() == [] and linked.collect() == []


def test_vocabularies(both):
    restored = alignment.Tokenizers.restored(both[2].value)
    assert all(restored.tokens[0][k] == restored.tokens[1][s] for k, s in enumerate(restored.same.tolist()) if s >= 0)
    assert restored.splits and len(restored.tokens[0]) == 50257 - 1


# --- whitening


def vectors(spark, *rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, n string, white string")


def whiten(df, **kw):
    return whitening.whiten(df, whitening.scaled(F.col("embedding"), 64, 1_000_000), **kw).collect()


def test_whitening_rows(spark):
    rnd = random.Random(4)
    own = [[rnd.gauss(0, k + 1) for k in range(5)] for _ in range(60)]
    rows = [(k % 50, v) for k, v in enumerate(own)] + [(None, own[0])] * 40 + [
        (100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4), (104, []), (105, [1.0, 2.0]),
    ]
    found = whiten(vectors(spark, *rows))
    kept = [(i, v) for i, v in rows if v and len(v) == 5 and all(c is not None and np.isfinite(c) for c in v)]
    assert len(found) == len(kept) == 100 and all(r["n"] == "x" for r in found)
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in kept]
    n, deviation, white, explained = brute.whitened(x, 16)
    expected = {tuple(v): (d, w) for (_, v), d, w in zip(kept, deviation, white, strict=True)}
    for r in found:
        d, w = expected[tuple(r["embedding"])]
        own_ = r["white"]
        assert (own_["n"], own_["deviation"]) == (n, d) and np.allclose(np.abs(own_["whitened"]), np.abs(w), atol=1e-9)
        assert np.allclose(own_["explained"], explained) and own_["identity_error"] < 1e-12


def test_whitening_by_multiplicity(spark):
    rnd = np.random.default_rng(3)
    own = rnd.normal(size=(30, 3))
    rows = [(k, v.tolist()) for k, v in enumerate(own)] + [(99, own[0].tolist())] * 20
    found = whiten(vectors(spark, *rows), by_multiplicity=True)
    z = np.array([r["white"]["whitened"] for r in found])
    assert found[0]["white"]["n"] == 50 and np.allclose(np.cov(z.T, bias=True), np.eye(3), atol=1e-9)


def test_whitening_large_and_flat(spark):
    """Entries beyond what doubles multiply exactly, and dimensions that don't vary."""
    rows = [(k, [float(k * k % 7) * 2.0**40, 3.0, (-1.0) ** k]) for k in range(20)]
    found = whiten(vectors(spark, *rows))
    x = [[int(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n = len(set(map(tuple, x)))
    for r in found:
        own = r["white"]
        assert own["n"] == n and own["deviation"] is None and own["whitened"][2] is None and own["whitened"][0] is not None
    huge = whiten(vectors(spark, (1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])))
    assert len(huge) == 3
    one = whiten(vectors(spark, (1, [1.0, 2.0]), (2, [1.0, 2.0])))
    assert [(r["white"]["n"], r["white"]["deviation"], r["white"]["whitened"]) for r in one] == [(1, 0, [None, None])] * 2
    assert one[0]["white"]["identity_error"] is None
    assert whiten(vectors(spark, (1, None))) == [] and whiten(vectors(spark, (1, None)).limit(0)) == []


def test_exact_products():
    rnd = np.random.default_rng(1)
    y = rnd.integers(-(1 << 45), 1 << 45, (50, 4))
    found = sum(part * (1 << power) for power, part in whitening.products(y).items())
    assert (found == y.astype(object).T @ y.astype(object)).all()


# --- quality


def test_quality_rows(spark, documents):
    good, bad = EN + ". ", "BUY!! NOW!! $$$ ### CHEAP!! "
    rows = [(k, (good if k % 2 else bad) * (1 + k % 7)) for k in range(80)]
    df = documents(*rows, (200, None), (201, ""), (None, good), (1, bad), (202, "word " * 200_000), (203, "\n\n"), (204, "漢字" * 500))
    labels = spark.createDataFrame(
        [(k, k % 2) for k in range(60)] + [(None, 1), (300, 0), (2, None), (1, 0)], "doc_id long, quality int"
    )
    trees = quality.learn(df, labels)
    found = quality.score(df, trees).collect()
    assert len(found) == 87 and all(0 <= r["score"] <= 1 for r in found)
    by_text = {r["text"]: r["score"] for r in found}
    assert all(by_text[t] == r["score"] for r in found if (t := r["text"]))  # a score hangs on the text only
    assert len({r["score"] for r in found if not r["text"]}) == 1
    assert all((r["score"] > 0.5) == (r["doc_id"] % 2 == 1) for r in found if r["doc_id"] is not None and 60 <= r["doc_id"] < 80)
    again = quality.score(df.repartition(5), quality.learn(df.repartition(3), labels.repartition(2))).collect()
    scores = [sorted((r["text"] or "", round(r["score"], 6)) for r in rows_) for rows_ in (again, found)]
    assert scores[0] == scores[1]


def test_quality_nothing_learned(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    df = documents((1, EN), (2, None))
    assert quality.learn(df, none) is None
    assert {r["score"] for r in quality.score(df, None).collect()} == {0.5}
    assert quality.score(documents(), quality.learn(documents(), none)).collect() == []
    one = quality.learn(df, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert all(r["score"] > 0.5 for r in quality.score(df, one).collect())


def test_quality_bound(spark, documents):
    """A sample smaller than the labelled rows still teaches."""
    df = documents(*[(k, (EN if k % 2 else "$$$ !!! ") * 3) for k in range(300)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, quality int")
    assert quality.chosen_labels(df, labels, "doc_id", "quality", 50).count() == 50
    trees = quality.learn(df, labels, rows=50)
    assert all((r["score"] > 0.5) == (r["doc_id"] % 2 == 1) for r in quality.score(df, trees).collect())


def test_trees_as_walked():
    """The flattened trees give what walking each tree node by node gives."""
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    trees = quality.grown(x, y, np.ones(400))

    def walk(row):
        total = trees.base
        for feature, border, value in zip(trees.feature, trees.border, trees.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > border[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    scores = trees.scores(x)
    assert np.allclose(scores, [walk(r) for r in x]) and ((scores > 0.5) == (y > 0)).mean() > 0.95
