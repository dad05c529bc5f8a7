"""Licence scans by sentence rules.

A text is cut into sentences, once line by line and once with wrapped lines joined up to blank
lines. Normalised sentences are looked up among the known licence sentences; a text then is a
sequence of identifiers. A rule is an ordered sequence of identifiers that has to occur without
another identifier in between. Of matches that lie within a longer one only the longer counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.shared import text_hash

# --- fixed values: sentences of public licences and notices ---
SENTENCES = {
    "apache-2-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2-you": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-2-use": "you may not use this file except in compliance with the License.",
    "apache-2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit-line": "Released under the MIT License.",
    "mit-line-2": "Licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by-nc-4-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-4-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "mpl-2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl-2-version": "2.0.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
}
RULES = (
    ("Apache-2.0", ("apache-2-line",)),
    ("Apache-2.0", ("apache-2-you", "apache-2-use")),
    ("Apache-2.0", ("apache-2-you", "apache-2-use", "apache-2-copy")),
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-line-2",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("GPL-3.0", ("gpl-3-line",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-implied")),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-line",)),
    ("CC-BY-4.0", ("cc-by-4-line",)),
    ("CC-BY-4.0", ("cc-by-4-text",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-line",)),
    ("CC0-1.0", ("cc0-line",)),
    ("MPL-2.0", ("mpl-2-subject", "mpl-2-version")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
)
# --- end of fixed values ---

_GAP = "[^a-z0-9]+"


def _normal(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), _GAP, " "))


def _sentences(text: Column, wrapped: bool) -> Column:
    if wrapped:  # lines flow together up to a blank line
        text = F.regexp_replace(text, "\r\n?", "\n")
        text = F.regexp_replace(F.regexp_replace(text, "\n[ \t]*\n", ". "), "\n", " ")
    return F.split(F.regexp_replace(text, "([.!?;:])[ \t]+", "$1\n"), "[\r\n]+")


def known_sentences(spark: SparkSession, sentences: dict[str, str]) -> DataFrame:
    """``(sentence_id, normal)``: a row per known sentence; ids with one text keep the first."""
    rows = F.array(*(F.struct(F.lit(k).alias("sentence_id"), F.lit(v).alias("said")) for k, v in sentences.items()))
    listed = spark.range(1, numPartitions=1).select(F.inline(rows))
    return listed.groupBy(_normal(F.col("said")).alias("normal")).agg(F.min("sentence_id").alias("sentence_id"))


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """``(doc_id, licence, sentences, matches)``: by text and licence, how many sentences its
    longest matched rule has and how often it matches (in the reading, line by line or wrapped,
    that matches it more often).

    Null and empty texts have no match. Texts are told apart by doc_id and content, so rows
    equal in both count once; rows that differ only in text merge in the result. A null doc_id
    is kept. Other columns are ignored; no row gives no row.
    """
    known = known_sentences(docs.sparkSession, sentences)
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    lists = F.array(
        *(F.struct(F.lit(w).alias("wrapped"), _sentences(F.col("text"), w).alias("list")) for w in (False, True))
    )
    cut = texts.select("doc_id", "text_hash", F.explode(lists).alias("v")).select(
        "doc_id", "text_hash", "v.wrapped", F.posexplode("v.list").alias("at", "sentence")
    )
    # the known sentences are as many as the parameter holds
    met = cut.select("doc_id", "text_hash", "wrapped", "at", _normal(F.col("sentence")).alias("normal")).join(F.broadcast(known), "normal")
    runs = (
        met.groupBy("doc_id", "text_hash", "wrapped").agg(F.array_sort(F.collect_set(F.struct("at", "sentence_id"))).alias("s"))
        .select("doc_id", "text_hash", "wrapped", F.transform("s", lambda x: x["sentence_id"]).alias("ids"))
    )
    hits = F.flatten(F.array(*(_hits(licence, ids) for licence, ids in rules)))
    found = runs.withColumn("hits", hits).select(
        "doc_id", "text_hash", "wrapped",
        F.explode(F.expr("filter(hits, h -> not exists(hits, o -> o.first <= h.first and o.first + o.n >= h.first + h.n and o.n > h.n))")).alias("h"),
    )
    each = found.groupBy("doc_id", "text_hash", "wrapped", "h.licence").agg(F.max("h.n").alias("n"), F.count("*").alias("k"))
    return each.groupBy("doc_id", "licence").agg(F.max("n").cast("long").alias("sentences"), F.max("k").alias("matches"))


def _hits(licence: str, ids: tuple[str, ...]) -> Column:
    """(licence, first, n) wherever the rule's identifiers stand in the sequence."""
    same = " and ".join(f"element_at(ids, i + {k}) = '{x}'" for k, x in enumerate(ids))
    n = len(ids)
    places = f"if(size(ids) < {n}, array(), filter(sequence(1, size(ids)), i -> i + {n - 1} <= size(ids) and {same}))"
    return F.expr(f"transform({places}, i -> named_struct('licence', '{licence}', 'first', i, 'n', {n}))")


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def oracle(sentences: dict[str, str] = SENTENCES, rules=RULES) -> str:
    """The same in DuckDB's SQL: joins of the numbered identifiers instead of arrays."""
    known = ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in sentences.items())
    normal = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    hits = []
    for licence, ids in rules:
        joins = "".join(
            f" JOIN seq s{k} ON s{k}.doc_id IS NOT DISTINCT FROM s0.doc_id AND s{k}.text = s0.text AND s{k}.wrapped = s0.wrapped AND s{k}.i = s0.i + {k} AND s{k}.id = '{x}'"
            for k, x in enumerate(ids) if k
        )
        hits.append(f"SELECT s0.doc_id, s0.text, s0.wrapped, s0.i AS first, {len(ids)} AS n, '{licence}' AS licence FROM seq s0{joins} WHERE s0.id = '{ids[0]}'")
    return f"""
WITH known AS (SELECT min(id) AS id, {normal.format("said")} AS normal FROM (VALUES {known}) v(id, said) GROUP BY 2),
texts AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
views AS (
  SELECT doc_id, text, false AS wrapped, text AS flow FROM texts
  UNION ALL SELECT doc_id, text, true, regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n[ \\t]*\\n', '. ', 'g'), '\\n', ' ', 'g') FROM texts
), lists AS (
  SELECT doc_id, text, wrapped, regexp_split_to_array(regexp_replace(flow, '([.!?;:])[ \\t]+', '\\1' || chr(10), 'g'), '[\\r\\n]+') AS list FROM views
), cut AS (
  SELECT doc_id, text, wrapped, unnest(list) AS sentence, generate_subscripts(list, 1) AS at FROM lists
), seq AS (
  SELECT c.doc_id, c.text, c.wrapped, k.id, row_number() OVER (PARTITION BY c.doc_id, c.text, c.wrapped ORDER BY c.at) AS i
  FROM cut c JOIN known k ON k.normal = {normal.format("c.sentence")}
), hits AS ({" UNION ALL ".join(hits)}),
longest AS (
  SELECT * FROM hits h WHERE NOT EXISTS (
    SELECT 1 FROM hits o WHERE o.doc_id IS NOT DISTINCT FROM h.doc_id AND o.text = h.text AND o.wrapped = h.wrapped
      AND o.first <= h.first AND o.first + o.n >= h.first + h.n AND o.n > h.n)
), e AS (SELECT doc_id, text, wrapped, licence, max(n) AS n, count(*) AS k FROM longest GROUP BY ALL)
SELECT doc_id, licence, CAST(max(n) AS BIGINT) AS sentences, max(k) AS matches FROM e GROUP BY doc_id, licence
"""
