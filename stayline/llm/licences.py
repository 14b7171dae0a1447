"""Licence recognition by sentences and rules, with DataFrame functions only.

A text is brought into normal form with marks where a sentence may start or end. A known licence sentence between two
marks stands for its identifier; it may run on over line breaks, comment marks, colons and semicolons. Rules, tried in
order, name the licence of a run of identifiers and take that run out of the sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import table

# -- fixed values: licence sentences in normal form (lower case, letters and digits, single spaces) ------
SENTENCES = {
    "mit_name": ["released under the mit license", "licensed under the mit license", "the mit license", "mit license", "this project is licensed under the mit license"],
    "mit_grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit_notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as_is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "no_liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "apache2_name": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "apache license version 2 0", "released under the apache license version 2 0"],
    "apache_use": ["you may not use this file except in compliance with the license"],
    "apache_copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at"],
    "apache_as_is": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "apache_see": ["see the license for the specific language governing permissions and limitations under the license"],
    "gpl3_name": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "gnu general public license version 3"],
    "gpl2_name": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "gnu general public license version 2"],
    "gpl_free_3": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl_free_2": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl_hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl_see": ["see the gnu general public license for more details"],
    "lgpl_name": ["licensed under the gnu lesser general public license version 3", "this work is licensed under the gnu lesser general public license version 3"],
    "agpl_name": ["licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3"],
    "bsd_grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd_source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd_binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd_endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd_name": ["licensed under the bsd 3 clause license", "released under the bsd license"],
    "mpl_name": ["licensed under the mozilla public license version 2 0", "this source code form is subject to the terms of the mozilla public license v 2 0"],
    "cc_by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc_by_sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc_by_nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc0": ["licensed under cc0 1 0", "this work is dedicated to the public domain"],
    "isc_grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "rights": ["all rights reserved"],
    "proprietary": ["unauthorized copying of this file via any medium is strictly prohibited"],
}
# Rules in the order in which they are tried: licence, then the run of sentence identifiers.
RULES = [
    ("MIT", ["mit_name", "mit_grant", "mit_notice", "as_is", "no_liability"]),
    ("MIT", ["mit_grant", "mit_notice", "as_is", "no_liability"]),
    ("MIT", ["mit_grant", "mit_notice", "as_is"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("Apache-2.0", ["apache2_name", "apache_use", "apache_copy", "apache_as_is", "apache_see"]),
    ("Apache-2.0", ["apache2_name", "apache_use", "apache_copy"]),
    ("GPL-3.0-or-later", ["gpl_free_3", "gpl_hope", "gpl_see"]),
    ("GPL-3.0-or-later", ["gpl_free_3"]),
    ("GPL-2.0-or-later", ["gpl_free_2", "gpl_hope", "gpl_see"]),
    ("GPL-2.0-or-later", ["gpl_free_2"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("ISC", ["isc_grant"]),
    ("MIT", ["mit_name"]),
    ("Apache-2.0", ["apache2_name"]),
    ("GPL-3.0-only", ["gpl3_name"]),
    ("GPL-2.0-only", ["gpl2_name"]),
    ("LGPL-3.0-only", ["lgpl_name"]),
    ("AGPL-3.0-only", ["agpl_name"]),
    ("BSD-3-Clause", ["bsd_name"]),
    ("MPL-2.0", ["mpl_name"]),
    ("CC-BY-4.0", ["cc_by"]),
    ("CC-BY-SA-4.0", ["cc_by_sa"]),
    ("CC-BY-NC-4.0", ["cc_by_nc"]),
    ("CC0-1.0", ["cc0"]),
    ("LicenseRef-proprietary", ["rights", "proprietary"]),
    ("LicenseRef-proprietary", ["proprietary"]),
]
# Line breaks, words that open a comment line, and 'v. 2', whose point ends nothing.
BREAK = "(?>\\r\\n|\\r|\\n)"
COMMENT_WORD = f"{BREAK}[ \\t]*(?:dnl|@?rem)(?![a-z0-9])"
VERSION = "(?<![a-z0-9])v\\.(?=[^a-z0-9]{1,40}[0-9])"
# Where a sentence ends in any case: a mark before white space, a line without a letter or digit, a list number like '2)'.
END = f"[.!?]+(?=[ \\t\\r\\n])|{BREAK}[^a-z0-9\\r\\n]*(?=[\\r\\n])|{BREAK}[^a-z0-9\\r\\n]*[0-9a-z]{{1,2}}\\)[ \\t]"
# Where it may end or run on: a colon or semicolon before white space, a line break.
PAUSE = "[;:]+[ \\t]|[\\r\\n]"
# -------------------------------------------------------------------------------------------------------
#: Words that every known sentence has one of; texts without one, in normal form, aren't searched.
HINTS = "(?i)licen|software|permission|copyright|redistribut|warrant|liable|program|public domain|rights reserved|copying"


def marked(text: Column) -> Column:
    """Normal form of a whole text, with ``#`` for each END and ``|`` for each PAUSE, and ``#`` at both ends."""
    out = F.translate(F.lower(text), "|#", "  ")
    out = F.concat(F.lit("\n"), out, F.lit("\n"))
    for pattern, mark in [(COMMENT_WORD, "\n"), (VERSION, "v"), (END, "#"), (PAUSE, "|"), ("[^a-z0-9|#]+", " "), ("[ |]*#[ |#]*", "#"), (" ?\\|[ |]*", "|")]:
        out = F.regexp_replace(out, pattern, mark)
    return F.concat(F.lit("#"), out, F.lit("#"))


def known_sentences(spark: SparkSession) -> DataFrame:
    """``sentence``, ``sentence_id``: the fixed list above."""
    return spark.createDataFrame([(text, key) for key, texts in SENTENCES.items() for text in texts], "sentence string, sentence_id string")


def _recognise(sequence: Column) -> Column:
    """Licences of a sequence written as `` |a| |b| ``, rule by rule; a rule takes all its runs out of the sequence."""
    rules = F.array(*[F.struct(F.lit("".join(f"|{s}|" for s in ids)).alias("run"), F.lit(name).alias("name")) for name, ids in RULES])
    start = F.struct(sequence.alias("rest"), F.expr("CAST(array() AS array<string>)").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["run"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["run"], F.lit("/"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(rules, start, step)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, licences (distinct, sorted), sentences (identifiers in order),
    unmatched (known sentences that no rule took).

    Null and empty texts, and texts without a known sentence, have empty lists. Repeated rows are scanned again.
    A text is looked through where it lies, so nothing is shuffled.
    """
    pairs = [(text, key) for key, texts in SENTENCES.items() for text in texts]
    names = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    # The longest sentence first, as it may run on over a pause that also ends a shorter one.
    known = "[|#](" + "|".join(text.replace(" ", "[ |]") for text, _ in sorted(pairs, key=lambda p: -len(p[0]))) + ")(?=[|#])"
    # Through generators, as the optimizer would otherwise copy the expressions into each of their uses.
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.array(marked(F.coalesce("text", F.lit(""))))).alias("marked"))
    hits = F.when(F.translate("marked", "|#", "  ").rlike(HINTS), F.regexp_extract_all("marked", F.lit(known), 1)).otherwise(F.expr("CAST(array() AS array<string>)"))
    ids = F.transform(hits, lambda s: F.element_at(names, F.translate(s, "|", " ")))
    found = whole.select("doc_id", F.explode(F.array(ids)).alias("sentences"))
    sequence = F.array_join(F.transform("sentences", lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    state = found.select("doc_id", "sentences", F.explode(F.array(_recognise(sequence))).alias("state"))
    rest = F.filter(F.split(F.col("state.rest"), "[|/]+"), lambda i: i != "")
    return state.select("doc_id", F.array_sort(F.array_distinct("state.found")).alias("licences"), "sentences", rest.alias("unmatched"))


def licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, licences, n_sentences, n_unmatched of every document."""
    found = scan(table(spark, folder, "documents"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), F.array_join("sentences", ",").alias("sentences"), F.size("sentences").cast("long").alias("n_sentences"), F.size("unmatched").cast("long").alias("n_unmatched"))


def _sql() -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({text(t)}, {text(k)})" for k, ts in SENTENCES.items() for t in ts)
    steps, seq = [], "s0"
    for n, (name, ids) in enumerate(RULES, 1):
        run = text("".join(f"|{i}|" for i in ids))
        steps.append(f"s{n} AS (SELECT doc_id, sentences, replace(rest, {run}, '/') AS rest, CASE WHEN contains(rest, {run}) THEN list_append(found, {text(name)}) ELSE found END AS found FROM {seq})")
        seq = f"s{n}"
    return f"""
WITH known(sentence, sentence_id) AS (VALUES {known}),
parts AS (SELECT doc_id, unnest(list_zip(p, range(len(p)))) AS z
          FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '[.!?;:]+[ \\t]+|[ \\t]*[\\r\\n]+') AS p FROM documents)),
hits AS (SELECT doc_id, z[2] AS pos, sentence_id
         FROM parts JOIN known ON trim(regexp_replace(lower(z[1]), '[^a-z0-9]+', ' ', 'g')) = sentence),
seqs AS (SELECT doc_id, list(sentence_id ORDER BY pos) AS ids FROM hits GROUP BY doc_id),
s0 AS (SELECT d.doc_id, coalesce(ids, []) AS sentences,
              coalesce(array_to_string(list_transform(ids, lambda i: '|' || i || '|'), ''), '') AS rest, CAST([] AS VARCHAR[]) AS found
       FROM documents d LEFT JOIN seqs USING (doc_id)),
{", ".join(steps)}
SELECT doc_id, array_to_string(list_sort(list_distinct(found)), ',') AS licences, array_to_string(sentences, ',') AS sentences,
       len(sentences) AS n_sentences,
       len(list_filter(string_split_regex(rest, '[|/]+'), lambda i: i <> '')) AS n_unmatched
FROM {seq}
"""


SQL = _sql()
