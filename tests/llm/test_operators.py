"""Each operator against its plain version, on texts with all the odd cases."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from caremill.llm import decontaminate, idfiles, language, licences, near, pack, repeats, storage, suffixes, toxicity
from caremill.llm import vectors, words
from caremill.llm.links import components
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, row string, matches string, removed string"


def _corpus(seed=1, n=60):
    """Copies, near copies, shared passages, periodic, very long, empty and null texts; columns with clashing names."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéöß") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = [None, "", "  \n ", "one", "One one", "a b c d", "x " * 90, ("p q r s t " * 40).strip(), "123 !!"]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(30_000)))
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.3 and texts[-1]:
            copy = texts[rng.randrange(9, len(texts))].split()
            for _ in range(rng.choice([0, 0, 1, 3, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n"]).join(copy))
        else:
            own = [rng.choice(vocabulary) for _ in range(rng.randint(3, 150))]
            if kind < 0.5:
                own.insert(rng.randrange(len(own)), passage)
            texts.append(" ".join(own))
    return [(i * 3 - 7, t, "xy", "r", "m", "v") for i, t in enumerate(texts)], passage


ROWS, PASSAGE = _corpus()
PLAIN = [(r[0], r[1]) for r in ROWS]


@pytest.fixture(scope="module")
def documents(spark):
    storage.configure(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def doubled(spark):
    """Each row twice, and two without id."""
    return spark.createDataFrame([*ROWS, *ROWS, (None, PASSAGE, None, "r", "m", "v"), (None, None, None, "r", "m", "v")], SCHEMA)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_words_and_hashes():
    texts = ["A b\tc", None, "", "  longer-than-eight  é ", "b"]
    w = words.split_words(pa.array(texts), words.NOT_SPACE, lower=True)
    found = [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
    assert found == ["a", "b", "c", "longer-than-eight", "é", "b"] and w.counts.tolist() == [3, 0, 0, 2, 1]
    h = w.hashes()
    assert h[1] == h[5] and len(set(h.tolist())) == 5
    assert w.join(np.array([0, 3, 0]), np.array([2, 5, 0])).to_pylist() == ["a b", "longer-than-eight é", ""]


def test_groups_are_not_cut():
    keys = np.sort(np.random.default_rng(0).integers(0, 9, 500))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 7])], ["k"]) for i in range(0, 500, 7)]
    tables = list(words.by_key(iter(batches), "k", 20))
    assert sum(t.num_rows for t in tables) == 500
    seen = [set(t.column("k").to_pylist()) for t in tables]
    assert sum(map(len, seen)) == len(set(keys.tolist()))


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2)) if a != b] + [(i, i + 1) for i in range(400, 460)]
    nodes = {x for link in links for x in link}
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == brute.components(nodes, links)


def test_substring_dedup(documents, doubled, empty):
    expected = sorted(brute.repeated(PLAIN))
    for df in (documents, doubled):
        found = repeats.without_repeats(df).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
        assert _rows(found) == expected
    assert repeats.without_repeats(empty).count() == 0


def test_crowded_seeds_are_taken_apart(documents, spark):
    # Almost every seed is crowded; a column's name clashes with one used inside.
    removed = repeats.without_repeats(documents, crowd=1).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert _rows(removed) == sorted(brute.repeated(PLAIN))
    # A line of a few words between words of their own, and a passage that begins with it.
    rng = random.Random(7)
    own = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(40)]
    rows = []
    for i, words_of in enumerate(own):
        middle = "this line is on every page" if i % 3 else f"this line is on every page {PASSAGE}"
        rows.append((i, " ".join([*words_of[:30], middle, *words_of[30:]])))
    rows += [(100 + i, text) for i, text in rows[:10]]
    df = spark.createDataFrame([(*r, "x") for r in rows for _ in range(2)], "doc_id bigint, text string, _rank string")
    for crowd in (3, 1000):
        found = repeats.without_repeats(df, crowd=crowd).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
        assert _rows(found) == sorted(brute.repeated(rows))
    whole = [{(r.doc_id, r.start, r.n_words) for r in suffixes.matches(df, crowd=c).collect()} for c in (1, 3, 1000)]
    assert whole[0] == whole[1] == whole[2] and len(whole[0]) > 10


def test_sparse_suffixes_find_every_repeat(documents, doubled, empty):
    expected = brute.repeated_words(PLAIN, 50)
    for df in (documents, doubled):
        covered = defaultdict(set)
        text = {d: brute.words(t) for d, t in PLAIN}
        for r in suffixes.matches(df).collect():
            covered[r.doc_id].update(range(r.start, r.start + r.n_words))
            covered[r.source_doc_id].update(range(r.source_start, r.source_start + r.n_words))
            one = text[r.doc_id][r.start : r.start + r.n_words]
            assert len(one) >= 50 and one == text[r.source_doc_id][r.source_start : r.source_start + r.n_words]
        assert covered == expected
    assert suffixes.matches(empty).count() == 0


def test_near_duplicates(documents, doubled, empty):
    expected = sorted(brute.near_copies(PLAIN))
    assert sum(not r[3] for r in expected) > 5
    for df in (documents, doubled):
        assert _rows(near.near_duplicates(df)) == expected
    assert near.near_duplicates(empty).count() == 0
    kept = near.without_near_duplicates(documents)
    assert kept.columns == documents.columns and kept.count() == sum(r[3] for r in expected)


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    for keep in (1.0, 0.9, 0.75):
        n = int(1000 * 2 * keep / (1 + keep))
        other = np.sort(np.concatenate([base[:n], rng.integers(0, 1 << 63, 1000 - n).astype(np.uint64)]))
        sketch = near.odd_sketches(near.samples([np.sort(base), other]))
        differ = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
        expected = near.SKETCH_BITS / 2 * (1 - np.exp(-2 * near.SAMPLES * 2 * (1 - keep) / near.SKETCH_BITS))
        assert abs(differ - expected) < 40 and differ <= near.MOST_BITS


@pytest.mark.parametrize("part_bytes", [1 << 20, 200])
def test_decontamination(spark, documents, empty, part_bytes):
    w = PASSAGE.split()
    items = [(1, " ".join(w[:20])), (2, " ".join(w[30:43]).upper()), (3, "no such words"), (4, None), (5, ""), (6, "p q r")]
    items += [(7, " ".join(w[5:40])), (7, "one"), (None, "a b c d")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.judged(decontaminate.verbatim_matches(documents, benchmark, part_bytes=part_bytes))
    result = found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert _rows(result) == sorted(brute.contaminated(PLAIN, items))
    assert decontaminate.judged(decontaminate.verbatim_matches(empty, benchmark)).count() == 0
    nothing = decontaminate.decontaminate(documents, benchmark.limit(0))
    assert nothing.columns == documents.columns and nothing.count() == len(ROWS)


def _ids(file, text):
    library = Tokenizer.from_file(public_tokenizers.path(file))
    return library.encode(text or "", add_special_tokens=False).ids


def test_packing(documents, empty):
    pieces = pack.pack(documents, public_tokenizers.path("byte_bpe_50k.json"), end_id=0).collect()
    ids = {d: [*_ids("byte_bpe_50k.json", t), 0] for d, t in PLAIN}
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = np.frombuffer(p.ids, "<u4").tolist()
        assert own == ids[p.doc_id][p.start : p.start + p.length] and p.doc_tokens == len(ids[p.doc_id])
        of_doc[p.doc_id].append((p.start, p.length))
        of_sequence[p.sequence_id].append((p.offset, p.length))
    for cuts, most in [(of_doc[d], len(ids[d])) for d in ids] + [(s, 1024) for s in of_sequence.values()]:
        at = 0
        for start, length in sorted(cuts):
            assert start == at and length > 0
            at += length
        assert at <= most and (most == 1024 or at == most)
    assert pack.pack(empty, public_tokenizers.path("byte_bpe_50k.json"), end_id=0).count() == 0


def test_differencing_balances_and_raises_the_count():
    sizes = np.random.default_rng(1).integers(1, 400, 300)
    window = pack.differencing(sizes, 20)
    sums = np.bincount(window, sizes, 20)
    assert sums.max() - sums.min() <= 2
    assert len(set(pack.deal(np.array([600, 600, 600])).tolist())) == 3


def test_id_files_round_trip(spark, documents, empty, tmp_path):
    file = public_tokenizers.path("word_bpe_49k.json")
    shards = idfiles.write(documents, f"file://{tmp_path}/ids", file, end_id=1, shards=4)
    before, expected = 0, []
    for d, t in sorted(PLAIN):
        ids = [*_ids("word_bpe_49k.json", t), 1]
        expected.append((d, before, ids))
        before += len(ids)
    found = [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in idfiles.read(shards).collect()]
    assert sorted(found) == expected
    assert idfiles.get(shards, expected[5][0])[0].tolist() == expected[5][2] and idfiles.get(shards, 10**9) == []
    assert idfiles.read(idfiles.write(empty, f"file://{tmp_path}/none", file, end_id=1, shards=2)).count() == 0


def test_id_files_with_repeated_and_missing_keys(doubled, tmp_path):
    shards = idfiles.write(doubled, f"file://{tmp_path}/ids", public_tokenizers.path("word_bpe_49k.json"), 1, shards=3)
    rows = idfiles.read(shards).collect()
    assert len(rows) == 2 * len(ROWS) + 2 and sum(r.doc_id is None for r in rows) == 2


def test_perfect_hash_has_no_gaps():
    keys = np.random.default_rng(2).choice(1 << 40, 5000, replace=False).astype(np.int64) - (1 << 39)
    index = idfiles.PerfectHash.of(keys)
    assert sorted(index.slot(keys).tolist()) == list(range(5000))


def test_language(spark, empty):
    rng = random.Random(0)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "vwxyzé"}
    rows = []
    for i in range(300):
        lang = rng.choice(list(letters))
        text = " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randint(2, 7))) for _ in range(20))
        rows.append((i, rng.choice([str.upper, str])(text), lang))
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 !?", None), (903, "abcde", None), (None, "vwx", "cc")]
    df = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string")
    model = language.fit(language.learned_from(df))
    found = language.identify(df.select("doc_id", "text"), model).select("row.*", "lang_pred", "score").collect()
    by_id = {r.doc_id: r for r in found}
    assert sum(by_id[i].lang_pred == lang for i, _, lang in rows) > 290
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by_id[None].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in found)
    nothing = language.fit(language.learned_from(empty))
    assert language.identify(df, nothing).select("lang_pred").distinct().collect()[0][0] == "und"


def test_language_keeps_rare_words(spark):
    """What is broadcast changes no result, and a large language does not push a small one's words out."""
    rng = random.Random(5)

    def text(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))

    rows = [(i, text("abcdefgh", 20), "large") for i in range(300)]
    rows += [(1000 + i, text("fghijké", 15), "small") for i in range(40)] + [(None, "fgfg hijk", "small")]
    rows += [(2000, "", "small"), (2001, None, "large"), (2002, "12 !?", None), (2003, "zzz Ξξ 𐐀𐐁", None), (2004, "zz fgh", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = language.learned_from(df)

    def found(model):
        rows = language.identify(df, model).select("row.doc_id", "row.lang", "lang_pred", "score").collect()
        return sorted((r.doc_id or -1, r.lang or "", r.lang_pred, round(r.score, 9)) for r in rows)

    whole = found(language.fit(learned))
    assert found(language.fit(learned, most_words=20, most_grams=6)) == whole
    assert found(language.fit(learned, most_words=1, most_grams=1)) == whole
    assert sum(lang == pred for _, lang, pred, _ in whole if lang == "small") > 35


def test_toxicity(spark, empty):
    rng = random.Random(0)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(500)]
    rows, labels = [], []
    for i in range(900):
        toxic = int(rng.random() < 0.15)
        text = [rng.choice(vocabulary) for _ in range(40)] + ["nasty" + rng.choice(vocabulary)] * (2 * toxic)
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        if rng.random() < 0.6:
            labels.append((i, toxic))
    df = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "x")], "doc_id bigint, text string")
    known = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, toxic int")
    classifier = toxicity.fit(df, known)
    score = {r.doc_id: r.score for r in toxicity.scored(df, classifier).select("row.doc_id", "score").collect()}
    right = sum((score[i] >= toxicity.THRESHOLD) == ("nasty" in t) for i, t in rows)
    assert right > 880 and score[1000] == score[1001] < 0.5 and all(0 <= s <= 1 for s in score.values())
    assert toxicity.scored(df, toxicity.fit(df, known.filter("toxic = 0"))).select(F.max("score")).first()[0] == 0
    assert toxicity.scored(empty, classifier).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    rows = []
    for i in range(240):
        v = base[rng.integers(40)] + rng.normal(size=16) * rng.choice([0, 0.05, 0.3])
        rows.append((i, v.tolist(), int(rng.integers(3))))
    odd = [None, [], [0.0] * 16, [None, *[1.0] * 15], [float("nan")] * 16, [float("inf"), *[1.0] * 15], [1.0, 2.0]]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, rows[0][1], None), (2001, [2.0, 4.0], 0)]
    schema = "vec_id bigint, embedding array<double>, label int"
    expected = sorted(brute.near_vectors(rows))
    assert sum(r[1] for r in expected) > 100
    for given in (rows, rows + rows[:50] + [(None, rows[0][1], 0)]):
        assert _rows(vectors.near_vectors(spark.createDataFrame(given, schema))) == expected
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_licences(spark, documents, empty):
    notice = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.\nReleased under the MIT License.\nSPDX-License-Identifier: Apache-2.0"
    )
    df = spark.createDataFrame([(1, notice), (2, "Licensed under CC BY-NC 4.0."), (3, None), (4, "")], "doc_id int, text string")
    found = {r.doc_id: r.licences for r in licences.scan(df).select("row.doc_id", "licences").collect()}
    assert found[1][:2] == ["GPL-3.0-or-later", "MIT"] and found[2] == ["CC-BY-NC-4.0"] and found[3] == found[4] == []
    sentences = spark.createDataFrame(licences.SENTENCES, "token string, sentence string")
    assert sentences.filter(~F.col("sentence").rlike(licences.HINT)).count() == 0
    assert sentences.filter(licences.normalised(F.col("sentence")) != F.col("sentence")).count() == 0
    assert licences.scan(documents).filter("size(tokens) > 0").count() == 0 and licences.scan(empty).count() == 0


MIT_TEXT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
BSD_TEXT = """ * Copyright (c) 2020, Someone. All rights reserved.
 *
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:
 *
 * 1. Redistributions of source code must retain the above copyright notice, this
 *    list of conditions and the following disclaimer.
 *
 * 2. Redistributions in binary form must reproduce the above copyright notice,
 *    this list of conditions and the following disclaimer in the documentation
 *    and/or other materials provided with the distribution.
"""
BSD_THIRD = """ *
 * 3. Neither the name of the copyright holder nor the names of its
 *    contributors may be used to endorse or promote products derived from
 *    this software without specific prior written permission.
"""
APACHE_TEXT = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
GPL_TEXT = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def test_whole_licence_texts(spark):
    """Standard texts as they stand in files: wrapped lines, blank lines, colons, comment signs, list marks."""
    brackets = BSD_TEXT.replace("1. ", "1) ").replace("2. ", "(b) ") + BSD_THIRD.replace("3. ", "iii) ")
    expected = [
        (MIT_TEXT, ["MIT"]),
        (MIT_TEXT.replace("\n", "\r\n"), ["MIT"]),
        (BSD_TEXT, ["BSD-2-Clause"]),
        (BSD_TEXT + BSD_THIRD, ["BSD-3-Clause"]),
        (brackets, ["BSD-3-Clause"]),
        (APACHE_TEXT, ["Apache-2.0"]),
        (GPL_TEXT, ["GPL-3.0-or-later"]),
        (GPL_TEXT.replace("software:", "software;").replace("version 3", "version 2"), ["GPL-2.0-or-later"]),
        ("// SPDX-License-Identifier: MIT\n", ["MIT"]),
        ("x = 1  \n/* SPDX-License-Identifier: Apache-2.0 */", ["Apache-2.0"]),
        ("# SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0-or-later"]),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", []),
        # A line before it without a mark, and a version on a line of its own.
        ("a | b |\nThis work is licensed under the GNU General Public License, version\n3.", ["GPL-3.0"]),
        (MIT_TEXT + GPL_TEXT + APACHE_TEXT, ["MIT", "GPL-3.0-or-later", "Apache-2.0"]),
        # Sentences of a rule with others in between are no notice.
        (MIT_TEXT.replace("The above", "Be kind.\n\nThe above"), []),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(expected)], "doc_id int, text string")
    found = {r.doc_id: r for r in licences.scan(df).select("row.doc_id", "tokens", "licences").collect()}
    for i, (text, names) in enumerate(expected):
        assert found[i].licences == names, text
    assert found[6].tokens == ["gpl-free-software", "gpl-3-or-later", "gpl-hope", "gpl-details"]


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its own input, against brute force where it removes something."""
    rows = [(i, t, "xy" if i % 2 else None, "s", len(t or "")) for i, t in PLAIN]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    w = PASSAGE.split()
    bench = [(1, " ".join(w[:30]))]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language identification"](spark, docs, folder)
    assert one.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in one.collect()]
    assert sorted(d for d, _ in kept) == sorted(d for d, t in PLAIN if any(c.isalpha() for c in t or ""))
    two = stages["near-duplicate removal"](spark, docs, folder)
    assert sorted(r.doc_id for r in two.collect()) == sorted(r[0] for r in brute.near_copies(PLAIN) if r[3])
    three = stages["substring dedup"](spark, docs, folder)
    whole = {r[0] for r in brute.repeated(PLAIN) if r[1] and r[1] == r[2]}
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} == {d for d, _ in PLAIN} - whole
    untouched = {r[0] for r in brute.repeated(PLAIN) if r[2] == 0}
    assert all(r.text == dict(PLAIN)[r.doc_id] for r in three.collect() if r.doc_id in untouched)
    four = stages["benchmark decontamination"](spark, docs, folder)
    assert {r.doc_id for r in four.collect()} == {r[0] for r in brute.contaminated(PLAIN, bench) if not r[5]}
    assert corpus_pipeline.run(spark, folder).count() > 0
