"""Licence scans by sentence rules.

A text is cut into pieces at line ends and marks. They are normalised (lower case; runs of anything but letters, digits
and dots within numbers become one space), and known licence sentences are looked up as runs of whole pieces, so that it
does not matter where a text wraps its lines or has a colon. A document's known sentences,
in order, are then matched against the ordered licence rules, each a sequence of sentence identifiers:
at each place the first rule in the order that fits there is taken, and the sentences it has matched are not used again.
Blank lines, comment signs and list marks between the sentences of a rule do not count.

All of it is DataFrame code on single rows; nothing is shuffled.

Cases: null and empty texts have no sentence and no licence; repeated rows and rows without doc_id are
one result row for each row; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.storage import configure

# Identifiers of licence sentences, and the normalised sentences from the licences' public texts and from
# the usual notices.
SENTENCES = [
    ("apache-2-licensed", "licensed under the apache license version 2.0"),
    ("apache-2-licensed", "licensed under the apache license version 2.0 the license"),
    ("apache-2-comply", "you may not use this file except in compliance with the license"),
    ("apache-2-obtain", "you may obtain a copy of the license at http www.apache.org licenses license 2.0"),
    (
        "as-is-basis",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    (
        "apache-2-limits",
        "see the license for the specific language governing permissions and limitations under the license",
    ),
    ("gpl-3-licensed", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2-licensed", "this work is licensed under the gnu general public license version 2"),
    ("gpl-free-software", "this program is free software"),
    (
        "gpl-3-or-later",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ),
    (
        "gpl-2-or-later",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 2 of the license or at your option any later version",
    ),
    (
        "gpl-hope",
        "this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose",
    ),
    ("gpl-details", "see the gnu general public license for more details"),
    ("mit-released", "released under the mit license"),
    ("mit-licensed", "licensed under the mit license"),
    (
        "mit-grant",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    (
        "mit-notice",
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software",
    ),
    (
        "bsd-redistribution",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    (
        "bsd-source",
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    ),
    (
        "bsd-binary",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    (
        "bsd-endorse",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    ("cc-by-nc-4", "licensed under cc by nc 4.0"),
    ("cc-by-4", "licensed under cc by 4.0"),
    ("cc-by-sa-4", "licensed under cc by sa 4.0"),
    ("spdx-mit", "spdx license identifier mit"),
    ("spdx-apache-2", "spdx license identifier apache 2.0"),
    ("spdx-gpl-3", "spdx license identifier gpl 3.0 or later"),
]

# The ordered licence rules. Longer ones come first, so that a notice counts once.
RULES = [
    ("Apache-2.0", ["apache-2-licensed", "apache-2-comply", "apache-2-obtain", "as-is-basis", "apache-2-limits"]),
    ("Apache-2.0", ["apache-2-licensed", "apache-2-comply", "apache-2-obtain"]),
    ("GPL-3.0-or-later", ["gpl-free-software", "gpl-3-or-later", "gpl-hope", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl-free-software", "gpl-2-or-later", "gpl-hope", "gpl-details"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("Apache-2.0", ["apache-2-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free-software", "gpl-3-or-later"]),
    ("GPL-2.0-or-later", ["gpl-free-software", "gpl-2-or-later"]),
    ("GPL-3.0", ["gpl-3-licensed"]),
    ("GPL-2.0", ["gpl-2-licensed"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["spdx-apache-2"]),
    ("GPL-3.0-or-later", ["spdx-gpl-3"]),
]

#: A piece ends at a line end, or at a mark before white space or the end of the text.
SENTENCE_END = r"[.!?;:](\s|\z)"
#: The mark of a list entry in brackets, as in "1) " or "(a) ", is a piece of its own; "1. " is one by its dot.
LIST_MARK = r"(?m)^([^\p{Alnum}\n]*(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})\))[ \t]"
#: What may stand between two sentences of a rule: nothing, or one list mark.
GAP = r"\n*(?:(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})\n)?"
#: Only texts with one of these can have a known sentence, so the others are not normalised.
HINT = "(?i)license|redistribut|this program|permission|copyright"
#: Any known sentence as whole pieces of a normalised text, the longest that fits. Pieces may end between any two words.
KNOWN = "(?<![^\n])({})(?![^\n])".format(
    "|".join(
        sentence.replace(".", "[.]").replace(" ", "[ \n]")
        for sentence in sorted({sentence for _, sentence in SENTENCES}, key=lambda x: (-len(x), x))
    )
)


def normalised(sentence: Column) -> Column:
    """Lower case, anything but letters and digits as one space; dots stay between letters or digits."""
    s = F.regexp_replace(F.lower(sentence), "[^a-z0-9.]+", " ")
    s = F.regexp_replace(F.regexp_replace(s, "(^| )[.]+", " "), "[.]+( |$)", " ")
    return F.trim(F.regexp_replace(s, " +", " "))


def rule_matches(tokens: Column, follows: Column) -> Column:
    """The names of the rules that match the list ``tokens``, greedily from the left. Sentences of a rule follow one
    another: ``follows`` says of each whether it does so directly."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, ids)).alias("ids")) for name, ids in RULES])

    def step(state: Column, i: Column) -> Column:
        def fits(rule: Column) -> Column:
            n = F.size(rule["ids"])
            in_row = F.forall(F.slice(follows, i + 1, n - 1), lambda x: x)
            return (F.slice(tokens, i, n) == rule["ids"]) & in_row

        rule = F.get(F.filter(rules, fits), F.lit(0))
        matched = F.struct(
            F.concat(state["names"], F.array(rule["name"])).alias("names"), (i + F.size(rule["ids"])).alias("next")
        )
        return F.when((i < state["next"]) | rule.isNull(), state).otherwise(matched)

    start = F.struct(F.array().cast("array<string>").alias("names"), F.lit(1).alias("next"))
    return F.aggregate(F.sequence(F.lit(1), F.size(tokens)), start, step, lambda state: state["names"])


def scan(documents: DataFrame) -> DataFrame:
    """Each row of ``documents`` (text) as the struct ``row``, with tokens (its known sentences in order) and licences
    (those of the rules that match, in order)."""
    text = F.when(F.col("text").rlike(HINT), F.col("text")).otherwise("")
    pieces = F.split(F.regexp_replace(F.regexp_replace(text, LIST_MARK, "$1\n"), SENTENCE_END, "\n"), "\n")
    plain = F.array_join(F.filter(F.transform(pieces, normalised), lambda s: s != ""), "\n")
    # Normal forms have no @: what is between two of them is a known sentence, or what lies between known sentences.
    parts = F.split(F.regexp_replace(plain, KNOWN, "@$1@"), "@")
    table = F.create_map(*[F.lit(x) for token, sentence in SENTENCES for x in (sentence, token)])
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    found = documents.select(row, parts.alias("parts")).select(
        "row",
        F.transform(
            F.filter("parts", lambda _, i: i % 2 == 1), lambda s: table[F.translate(s, "\n", " ")]
        ).alias("tokens"),
        F.transform(
            F.filter("parts", lambda _, i: i % 2 == 0), lambda s: s.rlike(rf"\A{GAP}\z")
        ).alias("follows"),
    )
    licences = F.when(F.size("tokens") == 0, F.array().cast("array<string>")).otherwise(
        rule_matches(F.col("tokens"), F.col("follows"))
    )
    return found.select("row", "tokens", licences.alias("licences"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(documents)
    return found.select(
        "row.doc_id",
        F.size("tokens").cast("bigint").alias("n_known"),
        F.array_join("tokens", ",").alias("tokens"),
        F.array_join("licences", ",").alias("licences"),
    )


def oracle() -> str:
    """The same in DuckDB's SQL, from the same fixed values, for texts whose known sentences stand on one line each."""

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    known = ", ".join(f"({text(sentence)}, {text(token)})" for token, sentence in SENTENCES)
    rules = ", ".join(f"({i}, {text(name)}, [{', '.join(map(text, ids))}])" for i, (name, ids) in enumerate(RULES))
    return rf"""
    WITH RECURSIVE known(sentence, token) AS (VALUES {known}),
    rules(ord, name, ids) AS (VALUES {rules}),
    cut AS (
        SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '[.!?;:](\s|\z)', chr(10), 'g'), chr(10)) AS s
        FROM documents
    ),
    sentences AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS place FROM cut),
    lower_case AS (
        SELECT doc_id, place, regexp_replace(lower(sentence), '[^a-z0-9.]+', ' ', 'g') AS s FROM sentences
        WHERE sentence ILIKE '%licens%' OR sentence ILIKE '%redistribut%' OR sentence ILIKE '%this program%'
           OR sentence ILIKE '%permission%' OR sentence ILIKE '%copyright%'
    ),
    plain AS (
        SELECT doc_id, place, trim(regexp_replace(regexp_replace(regexp_replace(
            s, '(^| )[.]+', ' ', 'g'), '[.]+( |$)', ' ', 'g'), ' +', ' ', 'g')) AS sentence FROM lower_case
    ),
    found AS (
        SELECT doc_id, place, token, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i
        FROM plain JOIN known USING (sentence)
    ),
    lists AS (SELECT doc_id, list(token ORDER BY i) AS tokens, list(place ORDER BY i) AS places FROM found GROUP BY doc_id),
    fits AS (
        SELECT f.doc_id, f.i, arg_min(r.name, r.ord) AS name, arg_min(len(r.ids), r.ord) AS n
        FROM found f JOIN lists l USING (doc_id) JOIN rules r
          ON l.tokens[f.i : f.i + len(r.ids) - 1] = r.ids AND l.places[f.i + len(r.ids) - 1] - f.place = len(r.ids) - 1
        GROUP BY f.doc_id, f.i
    ),
    walk AS (
        SELECT doc_id, CAST(1 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS names FROM lists
        UNION ALL
        SELECT w.doc_id, w.i + coalesce(f.n, 1), CASE WHEN f.name IS NULL THEN w.names ELSE list_append(w.names, f.name) END
        FROM walk w JOIN lists l ON l.doc_id = w.doc_id AND w.i <= len(l.tokens)
        LEFT JOIN fits f ON f.doc_id = w.doc_id AND f.i = w.i
    ),
    ends AS (SELECT doc_id, arg_max(names, i) AS names FROM walk GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(len(l.tokens), 0) AS BIGINT) AS n_known,
           coalesce(array_to_string(l.tokens, ','), '') AS tokens, coalesce(array_to_string(e.names, ','), '') AS licences
    FROM documents d LEFT JOIN lists l USING (doc_id) LEFT JOIN ends e USING (doc_id)
    """
