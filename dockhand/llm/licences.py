"""Licences recognised by their sentences.

A text falls into sentences, each is normalised and looked up among known licence
sentences, and the sequence of identifiers found is matched against ordered rules.  A rule
uses up the identifiers it matches, so a licence's full text is not taken for the shorter
forms that later rules know.  Everything happens inside the row: there is no shuffle, and
the tables of sentences and rules are part of the expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import LOWER, UPPER, Aside, lower_ascii, text_of

# Sentences of public licences and notices.
SENTENCES: dict[str, list[str]] = {
    "AllRights": ["All rights reserved."],
    "ApacheLine": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
    ],
    "ApacheGrant": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'],
    "ApacheCopy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "ApacheAsIs": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "ApacheSee": ["See the License for the specific language governing permissions and limitations under the License."],
    "MitLine": ["Released under the MIT License.", "Licensed under the MIT License."],
    "MitGrant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'],
    "MitNotice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "MitAsIs": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'],
    "IscGrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "BsdGrant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BsdSource": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "BsdBinary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "BsdNames": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "GplThree": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "GplTwo": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "GplThreeLater": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GplTwoLater": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GplHope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "MplLine": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CcBy": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CcBySa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CcByNc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CcZero": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "PublicDomain": ["This work is in the public domain.", "This is free and unencumbered software released into the public domain."],
}

# Licences and the identifiers that make them, the first match first.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["ApacheGrant", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdNames"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs"]),
    ("GPL-3.0-or-later", ["GplThreeLater", "GplHope"]),
    ("GPL-2.0-or-later", ["GplTwoLater", "GplHope"]),
    ("Apache-2.0", ["ApacheGrant"]),
    ("Apache-2.0", ["ApacheLine"]),
    ("MIT", ["MitGrant"]),
    ("MIT", ["MitLine"]),
    ("ISC", ["IscGrant"]),
    ("GPL-3.0-or-later", ["GplThreeLater"]),
    ("GPL-2.0-or-later", ["GplTwoLater"]),
    ("GPL-3.0-only", ["GplThree"]),
    ("GPL-2.0-only", ["GplTwo"]),
    ("MPL-2.0", ["MplLine"]),
    ("CC-BY-4.0", ["CcBy"]),
    ("CC-BY-SA-4.0", ["CcBySa"]),
    ("CC-BY-NC-4.0", ["CcByNc"]),
    ("CC0-1.0", ["CcZero"]),
    ("Public-Domain", ["PublicDomain"]),
    ("All-Rights-Reserved", ["AllRights"]),
]

# Between sentences; it does not occur inside one.
MARK = "\x1e"
SENTENCE_END = r"([.!?:])[\x20\x09-\x0D]+"
NOT_KEPT = "[^a-z0-9+]+"


def normalised(sentence: str) -> str:
    """A sentence as it is looked up: lower-cased letters, digits and ``+``, parted by spaces."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in sentence)
    return re.sub(NOT_KEPT, " ", lower).strip(" ")


def sentence_table(sentences: dict[str, list[str]]) -> dict[str, str]:
    """Identifiers by normalised sentence."""
    return {normalised(s): name for name, listed in sentences.items() for s in listed}


def pieces_of(sentence: str) -> list[str]:
    """The parts that a text's cut leaves of a sentence, normalised."""
    cut = re.sub(SENTENCE_END, r"\1" + MARK, sentence).split(MARK)
    return [piece for piece in map(normalised, cut) if piece]


def _starts(sentences: dict[str, list[str]]) -> str:
    """A regular expression of the first words of the sentences, as written or in capitals."""
    firsts = {tuple(re.findall("[A-Za-z0-9]+", s)[:3]) for listed in sentences.values() for s in listed}
    spelt = sorted({w for words in firsts if words for w in (words, tuple(x.upper() for x in words))})
    return "|".join("[^A-Za-z0-9]+".join(words) for words in spelt)


def _normalised(column: Column) -> Column:
    return F.btrim(F.regexp_replace(lower_ascii(column), NOT_KEPT, " "))


def scan_licences(
    df: DataFrame,
    text_col: str = "text",
    sentences: dict[str, list[str]] | None = None,
    rules: list[tuple[str, list[str]]] | None = None,
) -> DataFrame:
    """``df`` with the licences of each text; one row per input row.

    A sentence ends at ``.``, ``!``, ``?`` or ``:`` before a blank.  It may span lines; where
    it is not known as a whole, it also ends at a line without letters or digits and before a
    line that begins as a known sentence does, so that headings and copyright lines stay
    apart, and where that is not known either, each of its lines is looked up.  Known
    sentences are cut by the same rule, and found where all their parts follow each other.
    Added, in place of columns of the same names: ``n_sentences`` (by the first rule, with a
    letter or digit), ``sentence_ids`` (known ones, in the text's order), ``licences`` (in
    the rules' order, each once) and ``unmatched_ids`` (used by no rule), all three joined by
    commas.  A null or empty text has no sentences and empty strings.
    """
    sentences = SENTENCES if sentences is None else sentences
    rules = RULES if rules is None else rules
    cut = {tuple(pieces_of(s)): name for name, listed in sentences.items() for s in listed}
    known = {pieces[0]: name for pieces, name in cut.items() if len(pieces) == 1}
    # Parts of longer sentences have numbers, which no identifier begins with.
    longer = {pieces: name for pieces, name in cut.items() if len(pieces) > 1}
    for k, piece in enumerate(sorted({x for pieces in longer for x in pieces})):
        known.setdefault(piece, f"{k}#")
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else (
        F.create_map(F.lit(""), F.lit(None).cast("string"))
    )
    starts = _starts(sentences)
    line_break = r"\n(?=[^A-Za-z0-9\n]*(?:\n" + (f"|(?:{starts})(?![A-Za-z0-9])" if starts else "") + "))"
    aside = Aside(df)

    def named(part: Column) -> Column:
        return F.coalesce(F.element_at(table, _normalised(part)), F.lit(""))

    def lines(part: Column) -> Column:
        return F.when(named(part) == "", F.transform(F.split(part, "\n"), named)).otherwise(F.array(named(part)))

    def identifiers(part: Column) -> Column:
        """Of the part or of what it falls into, an empty one where nothing is known."""
        return F.when((named(part) != "") | ~F.contains(part, F.lit("\n")), F.array(named(part))).otherwise(
            F.flatten(F.transform(F.split(F.regexp_replace(part, line_break, MARK), MARK), lines))
        )

    split = F.split(F.regexp_replace(text_of(aside.name(text_col)), SENTENCE_END, "$1" + MARK), MARK)
    wrapped = F.array_join(F.transform(
        F.flatten(F.transform("_parts", identifiers)), lambda i: F.concat(F.lit("<"), i, F.lit(">"))
    ), "")
    for pieces, name in longer.items():
        wrapped = F.replace(wrapped, F.lit("".join(f"<{known[x]}>" for x in pieces)), F.lit(f"<{name}>"))
    found = aside.df.withColumn("_parts", split).withColumn(
        # Nothing and lone parts of longer sentences go.
        "_sequence", F.regexp_replace(wrapped, "<([0-9]+#)?>", "")
    ).withColumn("_ids", F.regexp_extract_all("_sequence", F.lit("<([^>]*)>"), F.lit(1)))
    steps = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids"))
        for name, ids in rules
    ])
    matched = found.withColumn("_matched", F.aggregate(
        steps,
        F.struct(F.col("_sequence").alias("left"), F.array().cast("array<string>").alias("names")),
        lambda state, rule: F.struct(
            # The mark keeps what was apart from becoming neighbours.
            F.replace(state["left"], rule["ids"], F.lit("|")).alias("left"),
            F.when(F.contains(state["left"], rule["ids"]), F.array_append(state["names"], rule["name"]))
            .otherwise(state["names"]).alias("names"),
        ),
    ))
    return matched.select(
        *aside.own(matched, ["n_sentences", "sentence_ids", "licences", "unmatched_ids"]),
        F.size(F.filter("_parts", lambda p: lower_ascii(p).rlike("[a-z0-9]"))).cast("bigint").alias("n_sentences"),
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.array_join(F.array_distinct("_matched.names"), ",").alias("licences"),
        F.array_join(
            F.regexp_extract_all("_matched.left", F.lit("<([^>]*)>"), F.lit(1)), ","
        ).alias("unmatched_ids"),
    )


def oracle_sql() -> str:
    """The same over ``documents`` in DuckDB's SQL, by joins instead of expressions."""
    values = ", ".join(
        f"('{s}', '{name}')" for s, name in sentence_table(SENTENCES).items()
    )
    normal = f"trim(regexp_replace(translate({{}}, '{UPPER}', '{LOWER}'), '{NOT_KEPT}', ' ', 'g'), ' ')"
    sequences = ["".join(f"<{i}>" for i in ids) for _, ids in RULES]
    found = [
        f"CASE WHEN contains(l{k}, '{s}') THEN '{name}' END"
        for k, (s, (name, _)) in enumerate(zip(sequences, RULES))
    ]
    steps = "".join(
        f", s{k + 1} AS (SELECT *, replace(l{k}, '{s}', '|') AS l{k + 1} FROM s{k})"
        for k, s in enumerate(sequences)
    )
    return f"""
WITH known(sentence, name) AS (VALUES {values}),
parts AS (
  SELECT doc_id, unnest(p) AS part, unnest(range(len(p))) AS k FROM (
    SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '{SENTENCE_END}', '\\1' || chr(30), 'g'), chr(30)) AS p
    FROM documents)),
whole AS (SELECT doc_id, k, part, name FROM parts LEFT JOIN known ON sentence = {normal.format("part")}),
lines AS (
  SELECT doc_id, k, unnest(l) AS line, unnest(range(len(l))) AS j FROM (
    SELECT doc_id, k, string_split(part, chr(10)) AS l FROM whole
    WHERE name IS NULL AND contains(part, chr(10)))),
named AS (
  SELECT doc_id, k, 0 AS j, name FROM whole WHERE name IS NOT NULL
  UNION ALL
  SELECT doc_id, k, j, name FROM lines JOIN known ON sentence = {normal.format("line")}),
sequences AS (
  SELECT doc_id, string_agg(name, ',' ORDER BY k, j) AS ids,
    string_agg('<' || name || '>', '' ORDER BY k, j) AS sequence FROM named GROUP BY doc_id),
s0 AS (
  SELECT d.doc_id, coalesce(ids, '') AS sentence_ids, coalesce(sequence, '') AS l0,
    (SELECT count(*) FROM parts p WHERE p.doc_id = d.doc_id AND regexp_matches(part, '[A-Za-z0-9]')) AS n_sentences
  FROM documents d LEFT JOIN sequences s ON d.doc_id = s.doc_id){steps}
SELECT doc_id, n_sentences, sentence_ids,
  array_to_string(list_distinct_in_order, ',') AS licences,
  array_to_string(regexp_extract_all(l{len(RULES)}, '<([^>]*)>', 1), ',') AS unmatched_ids
FROM (SELECT *, list_filter(found, lambda x, i: x IS NOT NULL AND list_position(found, x) = i) AS list_distinct_in_order
      FROM (SELECT *, [{', '.join(found)}] AS found FROM s{len(RULES)}))"""
