"""Every query of the subpackage over the smallest tables, against plain versions."""

import base64
import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import tokenizers
from conftest_llm import SF_DIR, brute, near

from tidemark.llm.queries import QUERIES, SOURCE_WEIGHTS, URL_RULES


def rows_of(spark, name, sf_dir=SF_DIR):
    return [r.asDict() for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]


def result(spark, name, key="doc_id"):
    found = QUERIES[name](spark, SF_DIR).collect()
    return {r[key]: r for r in found}, found


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in rows_of(spark, "documents")}


def test_op1(spark, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tokenizer = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found, all_ = result(spark, "op1_byte_bpe")
    assert len(all_) == len(texts)
    for i, text in texts.items():
        ids = tokenizer.encode_ordinary(text)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op2(spark, texts):
    found, all_ = result(spark, "op2_personal_data")
    assert len(all_) == len(texts)
    kinds = ("email", "ip", "card", "phone")
    for i, text in texts.items():
        base = brute.personal(text)
        written = [f"{kinds[k]}:{s}:{e}" for s, k, e in base]
        assert found[i]["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest(), (i, base)
        assert [found[i][f"n_{k}"] for k in kinds] == [sum(b[1] == n for b in base) for n in range(4)]
        assert set(written) <= set(found[i]["spans"].split(",")) | {""}


def test_op3(spark, texts):
    found, all_ = result(spark, "op3_suffix_dedup")
    assert len(all_) == len(texts)
    expected = dict(zip(texts, brute.cut(list(texts.items()))))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in found.items()} == expected
    assert sum(e[1] for e in expected.values()) > 1000


def test_op4(spark, texts):
    found, all_ = result(spark, "op4_lm_scoring")
    assert len(all_) == len(texts)
    learned = [not brute.left_out(i, 7, 2) for i in texts]
    for (i, learned_), e in zip(zip(texts, learned), brute.word_scores(list(texts.items()), learned)):
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not learned_, *e[:3])
        assert math.isclose(r["base_score"], e[3], rel_tol=1e-9)
    unseen = [r for r in all_ if r["held_out"]]
    # The base gives unseen words no share of its own, so with few documents it looks better than it is.
    assert sum(r["score"] for r in unseen) > 1.3 * sum(r["base_score"] for r in unseen)
    assert 1 < np.mean([r["bits_per_byte"] for r in unseen]) < 3


def test_op5(spark):
    found, all_ = result(spark, "op5_link_trust", "page_id")
    for page in rows_of(spark, "pages"):
        r = found[page["page_id"]]
        host, path, rule, verdict = brute.judge(page["url"], URL_RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")


def test_op6(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in rows_of(spark, "embeddings")}
    unit = {i: v / np.sqrt(v @ v) for i, v in vectors.items()}
    ids = sorted(unit)
    matrix = np.array([unit[i] for i in ids])
    linked = matrix @ matrix.T >= 0.95
    place = {i: k for k, i in enumerate(ids)}
    component = brute.reachable(ids, lambda a, b: linked[place[a], place[b]])
    found, all_ = result(spark, "op6_near_vectors", "vec_id")
    assert len(all_) == len(ids)
    for i in ids:
        r = found[i]
        assert (r["n_links"], r["component_id"], r["kept"]) == (linked[place[i]].sum() - 1, component[i], component[i] == i)


def test_op7(spark, texts):
    sets = {i: brute.shingles(t, 2) for i, t in texts.items()}
    component = brute.reachable(texts, lambda a, b: bool(sets[a]) and near(sets[a], sets[b], 80))
    found, all_ = result(spark, "op7_minhash")
    assert len(all_) == len(texts)
    for i in texts:
        r = found[i]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), component[i], component[i] == i)
    assert any(i != c for i, c in component.items())


def test_op8(spark):
    vectors = {r["vec_id"]: np.floor(256 * np.array(r["embedding"], np.float64)).astype(np.int64) for r in rows_of(spark, "embeddings")}
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in QUERIES["op8_top_k"](spark, SF_DIR).collect()}
    queries = [i for i in vectors if i % 50 == 0]
    assert len(found) == 5 * len(queries)
    for q in queries:
        best = sorted(((-int(v @ vectors[q]), i) for i, v in vectors.items() if i != q))[:5]
        assert [found[q, k + 1] for k in range(5)] == [(i, -s) for s, i in best]


def test_op9(spark, texts):
    documents = rows_of(spark, "documents")
    size = {d["doc_id"]: len(brute.words(d["text"])) for d in documents}
    sources = sorted({d["source"] for d in documents}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[d["doc_id"]] for d in documents if d["source"] == s) for s in sources}
    target = dict(zip(sources, brute.shares([total[s] for s in sources], SOURCE_WEIGHTS)))
    found, all_ = result(spark, "op9_mixing")
    again, _ = result(spark, "op9_mixing")
    assert found == again and len(all_) == len(documents)
    for d in documents:
        r = found[d["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[d["doc_id"]], total[d["source"]])
        assert math.isclose(r["target"], target[d["source"]], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    for s in sources:
        taken = sum(found[d["doc_id"]]["taken"] for d in documents if d["source"] == s)
        assert abs(taken - target[s]) <= max(size[d["doc_id"]] for d in documents if d["source"] == s)


def test_op10(spark, texts):
    found, all_ = result(spark, "op10_language_id")
    lang = {d["doc_id"]: d["lang"] for d in rows_of(spark, "documents")}
    assert len(all_) == len(lang)
    assert all(r["held_out"] == brute.left_out(i, 3, 1) and 0 <= r["score"] <= 1 for i, r in found.items())
    held = [i for i in lang if found[i]["held_out"]]
    assert np.mean([found[i]["lang_pred"] == lang[i] for i in held]) > 0.95


def test_op11(spark, texts):
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found, all_ = result(spark, "op11_alignment")
    assert len(all_) == len(texts)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    for i, expected in zip(texts, brute.aligned(tokenizer, processor, texts.values()), strict=True):
        assert tuple(found[i][n] for n in names) == expected


def test_op12(spark):
    rows = sorted(rows_of(spark, "embeddings"), key=lambda r: r["vec_id"])
    x = [[math.floor(64 * c) + 1_000_000 for c in r["embedding"]] for r in rows]
    n, deviation, white, explained = brute.whitened(x, 16)
    all_ = QUERIES["op12_whitening"](spark, SF_DIR).collect()
    assert len(all_) == 16 * len(rows)
    found = {(r["vec_id"], r["component"]): r for r in all_}
    signs = np.sign([found[rows[0]["vec_id"], k + 1]["whitened"] * white[0, k] for k in range(16)])
    for i, r in enumerate(rows):
        for k in range(16):
            f = found[r["vec_id"], k + 1]
            assert (f["n"], f["deviation"]) == (n, deviation[i])
            assert f["whitened"] == pytest.approx(signs[k] * white[i, k], abs=1e-8)
            assert f["explained"] == pytest.approx(explained[k], rel=1e-9) and f["identity_error"] < 1e-9


def test_op13(spark, texts):
    found, all_ = result(spark, "op13_quality")
    labels = {r["doc_id"]: r["quality"] for r in rows_of(spark, "labels")}
    assert len(all_) == len(texts)
    for i, r in found.items():
        assert r["held_out"] == brute.left_out(i, 4, 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [i for i in labels if found[i]["held_out"]]
    assert np.mean([found[i]["predicted"] == labels[i] for i in held]) > 0.9
