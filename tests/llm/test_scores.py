"""Exact top-k, alignment of two tokenizers and whitening against their plain versions, with all the odd cases."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caremill.llm import align, impacts, vectors, whitening
from caremill.llm.catalogue import QUERIES
from caremill.llm.tokens import _BYTE_LETTERS
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int, size int, shard int, x string, block int, c0 int, chunk int"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _vectors(n=400, size=12, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(20, size))
    rows = [(i - 100, [float(x) for x in np.float32(base[i % 20] + 0.4 * rng.normal(size=size))]) for i in range(n)]
    rows[7] = (rows[7][0], rows[27][1])  # ties
    rows[47] = (rows[47][0], rows[27][1])
    odd = [
        (9000, None), (9050, []), (9100, [1.0] * (size - 1) + [float("nan")]), (9150, [float("inf")] * size),
        (9200, [None] + [1.0] * (size - 1)), (None, rows[3][1]), (9250, [0.0] * size), (9300, [1.0, -2.0, 0.5]),
        (9350, [2.0, 2.0, 2.0]), (9400, [5.0]), rows[5], (rows[5][0], rows[9][1]), (9450, [-30000.0, 30000.0, 1e30]),
    ]
    return rows + odd


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x", 4, 5, 6) for i, v in rows], VECTORS).repartition(3)


def _top(spark, rows, k, shard_rows=64, every=50):
    vectors = impacts.impacts(_frame(spark, rows))
    found = impacts.search(impacts.build(vectors, shard_rows), vectors.filter(f"vec_id % {every} = 0"), k)
    return sorted(map(tuple, found.collect()))


def test_top_k_is_that_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(impacts, "QUERY_BLOCK", 3)
    monkeypatch.setattr(impacts, "HELD_BLOCKS", 2)
    rows = [r for r in _vectors() if r[0] != 9450]
    assert _top(spark, rows, 5) == brute.top_inner(rows, 5, lambda i: i % 50 == 0)
    assert _top(spark, rows, 500, 4096, 100) == brute.top_inner(rows, 500, lambda i: i % 100 == 0)


def test_a_vector_whose_scores_need_more_than_64_bits_takes_no_part(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (1, [2.0, 2.0, 2.0]), (9450, [-30000.0, 30000.0, 1e30])]
    assert _top(spark, rows, 5) == [(0, 1, 1, 786432)]


def test_large_and_negative_values_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-(2**19), 2**19)) for _ in range(6)]) for i in range(300)]
    assert _top(spark, rows, 4, 50) == brute.top_inner(rows, 4, lambda i: i % 50 == 0)


def test_no_query_and_no_row(spark):
    assert _top(spark, [(1, [1.0]), (2, [2.0])], 5) == [] and _top(spark, [], 5) == []


def test_a_shard_is_left_on_proof_before_all_postings_are_read():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(3000, 32)) / 32**0.5).astype(np.int64)
    x[17] = x[5] + rng.integers(-3, 4, 32)
    order = np.argsort(x.T, axis=1, kind="stable")
    values = np.take_along_axis(x.T, order, axis=1)
    shard = impacts.Shard.read(
        32, np.arange(3000).tobytes(), order.ravel().astype(np.int16).tobytes(), values.ravel().astype(np.int16).tobytes()
    )
    for query in (5, 900):
        ids, scores, read, possible = shard.top(query, x[query], 1)
        plain = x @ x[query]
        plain[query] = plain.min()
        assert ids[0] == np.argmax(plain) and scores[0] == plain.max()
        assert 0 < read < 0.9 * x.size and possible <= 3000 * impacts.LEFT_POSSIBLE + 1


def test_registered_queries_have_their_columns(spark):
    types = {
        "op11_exact_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
        "op12_alignment": dict.fromkeys(
            ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "bigint"
        ) | {"groups_sha256": "string"},
        "op13_whitening": {
            "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
            "explained": "double", "identity_error": "double",
        },
    }
    for name, wanted in types.items():
        assert dict(QUERIES[name](spark, SMALL).dtypes) == wanted, name


def _texts():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéößзаñ漢字") for _ in range(rng.randint(1, 9))) for _ in range(150)]
    texts = [None, "", " ", "  two  spaces ", "a<|endoftext|>b", "<s> </s> <unk> <0x41>", "has ▁ in it", "tab\tand\nline\n\n"]
    texts += ["emoji 😀😀 end", "é and ﬁ ligature", " nbsp", "x" * 300, "1234567 89,012.5", "trailing "]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(30)]
    texts += [texts[-1]] * 7 + [texts[-2]] * 2
    texts.append(" ".join(rng.choice(words) + rng.choice(["", ",", "  "]) for _ in range(6000)))
    return [(None if i == 16 else i - 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("chunk", "part"), [(align.CHUNK_BYTES, align.PART_BYTES), (2000, 500)])
def test_alignment_is_that_of_plain_loops(spark, chunk, part):
    one = Tokenizer.from_file(BYTES)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    byte_of = {letter: byte for byte, letter in _BYTE_LETTERS.items()}
    rows = _texts()
    schema = "doc_id bigint, text string, copies int, chunk string, text_key int, pair int, a int, count int"
    documents = spark.createDataFrame([(*r, 1, "c", 2, 3, 4, 5) for r in rows], schema).repartition(3)
    found = align.alignment(documents, BYTES, PIECES, chunk)
    out = align.per_document(documents, align.measures(found)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
    want = [
        (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "")
        for row in brute.alignments(rows, one, two, byte_of)
    ]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert any(w[1] == 0 for w in want) and any(w[1] > 5000 for w in want)
    if part < align.PART_BYTES:
        assert found.texts.select("chunk").distinct().count() > 3


def test_a_long_text_is_cut_without_changing_its_pieces(monkeypatch):
    pieces = align.Pieces(PIECES)
    text = _texts()[-1][1]
    whole = pieces.encode([text])[0].tolist()
    monkeypatch.setattr(align, "PART_BYTES", 400)
    assert pieces.by_word and len(pieces.parts(text)) > 20
    assert pieces.encode([text])[0].tolist() == whole
    for odd in ("y" * 2000, " " * 2000, "a  " * 900, "▁ " * 900):
        assert pieces.encode([odd])[0].tolist() == pieces.model.encode(odd)


def test_groups_can_be_read(spark):
    one, two = align.ByteLevel(BYTES), align.Pieces(PIECES)
    found = align.align(one, two, ["hello world", "▁", "again"])
    assert found.first_a.tolist()[1] == found.first_a.tolist()[2]
    assert found.spelled(one, two)[0].count(b"|") == found.first_group[1]
    assert found.spelled(one, two)[1] == b""


def test_alignment_of_no_documents(spark):
    documents = spark.createDataFrame([], "doc_id bigint, text string")
    found = align.alignment(documents, BYTES, PIECES)
    assert align.per_document(documents, align.measures(found)).collect() == []
    documents = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    found = align.alignment(documents, BYTES, PIECES)
    out = align.per_document(documents, align.measures(found)).collect()
    assert sorted(r.doc_id for r in out) == [1, 2] and all(r.n_links == 0 and r.groups_sha256 == "" for r in out)


def _whitened(spark, rows, most=32, units=None):
    units = units or whitening.Units(64.0, 1_000_000)
    df = _frame(spark, rows)
    return whitening.whiten(df, whitening.fit(df, units, most), units).collect()


@pytest.mark.parametrize("spread", [1.0, 1e-3])
def test_whitening_is_that_of_the_covariance(spark, spread):
    rng = np.random.default_rng(4)
    scales = np.geomspace(1, spread, 9)
    rows = [(i // 2, [float(v) for v in np.float32(100 * rng.normal(size=9) * scales + 3)]) for i in range(700)]
    rows += [(5000, None), (5001, []), (5002, [float("nan")] * 9), (5003, [None] * 9), (None, rows[0][1])]
    out = _whitened(spark, rows, 5)
    kept = [v for _, v in rows if v and None not in v and np.isfinite(v).all()]
    x = np.floor(64 * np.array(kept)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(0)
    centred = (n * x - total) / n
    e, w = np.linalg.eigh(centred.T @ centred / n)
    e, w = e[::-1], w[:, ::-1]
    assert len(out) == 5 * n and {r.n for r in out} == {n} and all(r.identity_error < 1e-9 for r in out)
    assert sorted(r.deviation for r in out if r.component == 1) == sorted(((n * x - total) ** 2).sum(1).tolist())
    for k in range(5):
        want = centred @ w[:, k] / np.sqrt(e[k])
        got = np.sort([r.whitened for r in out if r.component == k + 1])
        assert min(np.abs(got - np.sort(want)).max(), np.abs(got - np.sort(-want)).max()) < 1e-9
        assert {abs(r.explained / (e[k] / e.sum()) - 1) < 1e-12 for r in out if r.component == k + 1} == {True}


def test_whitening_leaves_out_what_has_no_spread(spark):
    rng = np.random.default_rng(4)
    flat = [(i, [float(a), 7.0, float(a), float(b)]) for i, (a, b) in enumerate(rng.normal(size=(50, 2)))]
    assert {r.component for r in _whitened(spark, flat)} == {1, 2}
    assert _whitened(spark, [(1, [1.0, 2.0])] * 3) == [] and _whitened(spark, []) == []
    two = _whitened(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [1.0]), (4, [2.0])])
    assert sorted((r.vec_id, r.n, round(abs(r.whitened), 9)) for r in two) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 2, 1)]


def test_deviations_beyond_64_bits_are_null(spark):
    out = _whitened(spark, [(1, [1e10]), (2, [-1e10]), (3, [0.0])], units=whitening.Units(64.0, 0))
    found = {r.vec_id: r.deviation for r in out}
    assert found[1] is None and found[2] is None and found[3] == 0
    assert whitening.Fit(3, [0], []).centred(np.array([[2**61]])).tolist() == [[3 * 2**61]]


def test_a_matrix_that_needs_the_shift_is_factored():
    gram = np.outer([1.0, 2.0, 3.0], [1.0, 2.0, 3.0])
    r = whitening._factor(gram, 10, True)
    assert np.allclose(r.T @ r, gram, atol=1e-2) and pa is not None


def test_a_row_without_label_does_not_hide_one_with_it(spark):
    rows = [(1, [1.0, 0.0], "x"), (1, [1.0, 0.0], None), (2, [1.0, 0.01], "x"), (3, [1.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string")
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
