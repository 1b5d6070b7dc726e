"""The dealt methods themselves: order of traversal, bytes a keyed read takes, names of special tokens, features."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from caremill.llm import idfiles, passages, repeats, storage, tokens, toxicity, vectors, words


def test_cells_are_visited_in_rising_order_up_to_the_radius():
    rng = np.random.default_rng(5)
    one, two = rng.random((30, 7)), rng.random((30, 9))
    two[:, 3] = two[:, 4]
    one[11] = 5.0
    query, code1, code2 = vectors.traversed(one, two, 0.8)
    for q in range(30):
        own = query == q
        sums = one[q][code1[own]] + two[q][code2[own]]
        assert (np.diff(sums) >= 0).all()
        every = {(i, j) for i in range(7) for j in range(9) if one[q, i] + two[q, j] <= 0.8}
        assert set(zip(code1[own].tolist(), code2[own].tolist())) == every and own.sum() == len(every)
    assert not (query == 11).any()
    assert all(len(x) == 0 for x in vectors.traversed(np.zeros((0, 3)), np.zeros((0, 2)), 1.0))


def test_no_cell_beyond_the_walk_holds_a_neighbour():
    rng = np.random.default_rng(6)
    rows = np.repeat(rng.normal(size=(50, 8)), 8, axis=0) + rng.normal(size=(400, 8)) * 0.2
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    first, second = vectors.kmeans(rows[:, :4], 12), vectors.kmeans(rows[:, 4:], 12)
    walk = vectors.traversed(vectors.bounds(rows[:, :4], first), vectors.bounds(rows[:, 4:], second), 2 - 2 * 0.93)
    visited = set(zip(*(x.tolist() for x in walk)))
    own1, own2 = vectors.nearest(rows[:, :4], first).tolist(), vectors.nearest(rows[:, 4:], second).tolist()
    a, b = np.nonzero(rows @ rows.T >= 0.93)
    assert all((i, own1[j], own2[j]) in visited for i, j in zip(a.tolist(), b.tolist()))
    assert len(visited) < 400 * 144 / 2


def test_codebooks_grow_with_the_vectors():
    sizes = [vectors.codewords_for(n) for n in (0, 1, 10_000, 100_000, 1_000_000, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == 16 and sizes[3] == 40 and sizes[4] == 125
    assert sizes[5] == vectors.SAMPLE // vectors.FITTED


def test_more_codewords_give_the_same_links(spark, monkeypatch):
    storage.configure(spark)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 10))
    rows = [(i, (base[i % 30] + rng.normal(size=10) * 0.15).tolist(), "x") for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    few = sorted(map(tuple, vectors.near_vectors(df).collect()))
    monkeypatch.setattr(vectors, "codewords_for", lambda n: 40)
    assert sorted(map(tuple, vectors.near_vectors(df).collect())) == few and sum(r[1] for r in few) > 100


class _Counted:
    """A file that counts what is read of it."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.read = raw, 0

    def read_at(self, n: int, at: int) -> bytes:
        self.read += n
        return self.raw[at : at + n]


@pytest.mark.parametrize("n", [1, 2_000, 200_000])
def test_a_keyed_read_takes_few_bytes_whatever_the_size(n):
    keys = sorted(np.random.default_rng(n).choice(1 << 40, n, replace=False).tolist())
    ids = np.arange(3 * n, dtype=np.uint32)
    raw = idfiles.shard_bytes([None, *keys], np.concatenate([[7], ids]).astype(np.uint32), np.append([0], 1 + 3 * np.arange(n + 1)), 4)
    for i in {0, n // 2, n - 1}:
        file = _Counted(raw)
        shard = idfiles.Shard(lambda dtype, count, at, file=file: idfiles.Stored(file, dtype, count, at))
        assert [x.tolist() for x in shard.get(keys[i])] == [[3 * i, 3 * i + 1, 3 * i + 2]]
        assert file.read < 5_000
    absent = [k for k in range(50) if k not in keys]
    whole = idfiles.Shard(lambda dtype, count, at: np.frombuffer(raw, dtype, count, at))
    assert all(whole.get(k) == [] for k in absent)
    first, records = whole.records_of(np.array(keys))
    assert first.tolist() == list(range(1, n + 1)) and set(records.tolist()) == {1}


def test_rows_without_key_or_of_one_key_are_spread_over_shards(spark, tmp_path):
    storage.configure(spark)
    texts = [" ".join(f"word{i}x{j}" for j in range(5)) for i in range(120)]
    rows = [(None, t) for t in texts] + [(7, t) for t in texts] + [(8, "last")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    shards = idfiles.write(df, f"file://{tmp_path}/ids", public_tokenizers.path("word_bpe_49k.json"), 1, shards=6)
    assert shards.count() >= 4
    read = idfiles.read(shards).collect()
    assert len(read) == 241 and sum(r.doc_id is None for r in read) == 120
    at = 0
    for r in sorted(read, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    found = idfiles.get(shards, 7)
    assert sorted(x.astype("<u4").tobytes() for x in found) == sorted(r.ids for r in read if r.doc_id == 7)
    assert len(idfiles.get(shards, 8)) == 1 and fs is not None


NAMING = [
    "hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|>b c", "<|startoftext|> x", "<|ENDOFTEXT|> Y z",
    "no name < | endoftext | >", "<|endoftext", "|> and more", "", None, "  <|endoftext|>\n\né <|startoftext|>",
]


@pytest.mark.parametrize(("file", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_names_of_special_tokens_give_the_ids_of_the_library(file, spaced):
    path = public_tokenizers.path(file)
    for names_are_text in (False, True):
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = names_are_text
        coder = tokens.Encoder(path, spaced, names_are_text=names_are_text)
        for _ in range(2):
            ids, bounds = coder.encode(pa.array(NAMING, pa.large_string()), 1)
            for i, text in enumerate(NAMING):
                expected = [*library.encode(text or "", add_special_tokens=False).ids, 1]
                assert ids[bounds[i] : bounds[i + 1]].tolist() == expected, (text, names_are_text)


def test_common_words_do_not_push_out_rare_toxic_ones(spark):
    """Few of the positives have the telling word, all have very many others."""
    storage.configure(spark)
    rng = np.random.default_rng(3)
    common = [f"plain{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 6 == 0
        text = " ".join(rng.choice(common, 120)) + (f" vile{i % 5}" if toxic else "")
        rows.append((i, text))
        if i < 700:
            labels.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    classifier = toxicity.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    found = toxicity.scored(df, classifier).selectExpr("row.doc_id", "score").collect()
    assert all((r.score >= toxicity.THRESHOLD) == (r.doc_id % 6 == 0) for r in found)


def _phrases_table(texts):
    n = len(texts)
    columns = {"seed": [0] * n, "print": list(range(n)), "doc_id": list(range(n)), "start": [0] * n, "again": [False] * n}
    return pa.table(columns | {"ahead": [0] * n, "phrase": texts})


def test_automata_decide_what_repeats(monkeypatch):
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 500, 60)]
    table = _phrases_table([" ".join(base[i : i + 30]) for i in (0, 0, 3, 9, 30)])
    found = [repeats.automaton_shard(20, most)(table) for most in (1, 4, 1000)]
    runs = [tuple(r.values()) for r in found[0].select(["print", "first", "windows", "source_doc_id", "source_start"]).to_pylist()]
    # Text 2 repeats text 0 from its fourth word on, and so does text 3 as far as text 0 goes; its rest is in text 2.
    assert runs == [(0, 0, 11, 0, 0), (1, 0, 11, 0, 0), (2, 0, 8, 0, 3), (2, 8, 3, 2, 8), (3, 0, 2, 0, 9), (3, 2, 3, 2, 8)]
    assert found[0].equals(found[1]) and found[0].equals(found[2])
    none = np.zeros(0, np.int64)
    monkeypatch.setattr(repeats, "locate", lambda passages, texts: (none, none, none))
    assert repeats.automaton_shard(20)(table).num_rows == 0


def test_crowded_seeds_are_taken_apart_without_a_second_pass_over_the_texts(spark):
    line = " ".join(f"common{i}" for i in range(12))
    rows = [(i, " ".join([*(f"a{i}_{j}" for j in range(60)), line, *(f"b{i // 2}_{j}" for j in range(60))])) for i in range(40)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    seen = spark.sparkContext.accumulator(0)
    documents = texts.select("doc_id", "text").mapInArrow(
        lambda batches: (seen.add(b.num_rows) or b for b in batches), texts.schema
    )

    def run(crowd):
        seen.value = 0
        window = repeats.WINDOW
        shard = repeats.automaton_shard(window)
        found = passages.recurring(documents, window, repeats.SEED_WORDS, shard, crowd).collect()
        return sorted((r.doc_id, r.start + i) for r in found for i in range(r.windows)), seen.value

    whole, passes = run(1000)
    apart, passes_apart = run(1)
    assert whole == apart and len(whole) > 1000
    # To count the seeds, to keep the phrases, and to cut them out: crowded seeds need no further pass.
    assert passes_apart == passes == 3 * len(rows)


def test_long_texts_are_cut_into_the_same_phrases():
    rng = np.random.default_rng(9)
    text = " ".join(f"w{i}" for i in rng.integers(0, 50, 1500))
    w = words.split_words(pa.array([text, None, "a b", text[:3000]]), words.NOT_SPACE)
    whole, parts = passages.phrases(w, 20, 4), passages.phrases(w, 20, 4, step=100)

    def windows(found):
        of = np.repeat(np.arange(len(found.lo)), found.windows)
        at = words.ranges(found.lo, found.windows)
        return sorted(zip(at.tolist(), found.at[of].tolist(), found.seed[of].tolist()))

    assert windows(whole) == windows(parts) and len(whole.lo) < len(parts.lo)
    assert len(passages.phrases(words.split_words(pa.array([], pa.string()), words.NOT_SPACE), 20, 4).lo) == 0
