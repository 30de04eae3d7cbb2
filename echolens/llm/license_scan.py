"""Licence scans: sentence recognition, then ordered rules over the sentences found.

A text is cut into paragraphs at lines without letters and digits (so a
comment's empty lines count), and normalised (lower case, runs of other
characters than letters and digits, comment marks too, to one space; closing
marks and line ends are kept as two kinds of border).  A known licence
sentence is one that stands between two borders; it may run over line ends,
not over closing marks, so wrapped texts and one-line notices are both read.
A copyright notice's years and holder are left out of it.  The known
sentences form the text's identifier sequence.  A rule is an ordered list of
identifiers; it matches where these stand in the sequence in that order
(other known sentences may lie between).  Rules are tried in their order,
and all that match are reported.

Everything is one projection of built-in functions: no shuffle, no user
function.  Only paragraphs with one of ``STEMS`` are normalised; every known
sentence has one (checked by a test), so this skips none.

Defined results: null and empty texts have no sentences and no licence; very
long texts are read whole; a repeated sentence is repeated in the sequence;
repeated rows are scanned each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEMS = "licen|copyright|permission|warrant|redistribut|spdx|public domain"

# Known licence sentences (fixed values), normalised; the identifiers name them in rules.
SENTENCES = (
    ("mit-line", "released under the mit license"),
    ("mit-line", "licensed under the mit license"),
    ("mit-name", "the mit license"),
    ("mit-name", "mit license"),
    ("mit-line", "spdx license identifier mit"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                  "documentation files the software to deal in the software without restriction"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the software"),
    ("as-is", "the software is provided as is without warranty of any kind express or implied"),
    ("apache-line", "licensed under the apache license version 2 0"),
    ("apache-line", "licensed under the apache license version 2 0 the license"),
    ("apache-line", "spdx license identifier apache 2 0"),
    ("apache-name", "apache license"),
    ("apache-use", "you may not use this file except in compliance with the license"),
    ("gpl3-line", "this work is licensed under the gnu general public license version 3"),
    ("gpl3-line", "licensed under the gnu general public license version 3"),
    ("gpl3-line", "spdx license identifier gpl 3 0 only"),
    ("gpl-line", "spdx license identifier gpl 2 0 only"),
    ("gpl-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation"),
    ("bsd-redist", "redistribution and use in source and binary forms with or without modification are permitted provided that "
                   "the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the "
                   "following disclaimer"),
    ("cc-by-nc-line", "licensed under cc by nc 4 0"),
    ("cc-by-nc-line", "this work is licensed under cc by nc 4 0"),
    ("cc-by-line", "licensed under cc by 4 0"),
    ("cc-by-line", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-line", "licensed under cc by sa 4 0"),
    ("cc0-line", "this work is in the public domain"),
    ("reserved", "copyright all rights reserved"),
)

# Full sentences of the published texts, which the ones above are the beginnings of or which differ from them.
_GPL = "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
PUBLISHED = (
    ("mit-name", "the mit license mit"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                  "documentation files the software to deal in the software without restriction including without limitation the "
                  "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
                  "persons to whom the software is furnished to do so subject to the following conditions"),
    ("as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the "
              "warranties of merchantability fitness for a particular purpose and noninfringement"),
    *(("gpl-free", start + _GPL + end) for start in ("this program is free software ", "")
      for v in ("2", "3") for end in (f"either version {v} of the license or at your option any later version",
                                      f"version {v} of the license", f"version {v}")),
)

# A copyright notice with years and holder, normalised to "copyright notice".  Many free licences begin with one, so it
# shows a proprietary text only where no rule matches.
NOTICE = "copyright(?:[ \x01][a-z0-9]+){1,30}?[ \x01\x02]all[ \x01]rights[ \x01]reserved"

# Ordered rules: licence and the identifiers that show it, in order.
RULES = (
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache-line",)),
    ("Apache-2.0", ("apache-name", "apache-use")),
    ("GPL-3.0", ("gpl3-line",)),
    ("GPL", ("gpl-line",)),
    ("GPL", ("gpl-free",)),
    ("BSD", ("bsd-redist", "bsd-source")),
    ("CC-BY-NC-4.0", ("cc-by-nc-line",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-line",)),
    ("CC-BY-4.0", ("cc-by-line",)),
    ("CC0", ("cc0-line",)),
    ("proprietary", ("reserved",)),
)


def pattern(ids: tuple) -> str:
    return "%" + "%".join(f"|{i}|" for i in ids) + "%"


def scan(docs: DataFrame, text: str = "text", sentences=SENTENCES, rules=RULES) -> DataFrame:
    """Per row: doc_id, sentence_ids, licenses (both in order, comma-separated), n_sentences known, license (the first)."""
    # \x01 is a line end inside a paragraph, \x02 a closing mark or a paragraph's border.
    lines = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), "\x01\x02", "  "), r"\n[^A-Za-z0-9\n]*(?=\n|$)")
    d = docs.select("doc_id", F.filter(lines, lambda s: s.rlike(f"(?i){STEMS}")).alias("s"))

    def norm(s):
        for old, new in ((r"(?:^|\n)[^a-z0-9\n]*(?:(?:dnl|rem)(?![a-z0-9]))?", "\x01"), (r"[.!?;]+(?=[ \t\r\n\x01]|$)", "\x02"),
                         (r"[^a-z0-9\x01\x02]+", " "), (r"[\x01 ]*\x02[\x01\x02 ]*", "\x02"), (r" *\x01[\x01 ]*", "\x01")):
            s = F.regexp_replace(s if old[0] != "(" else F.lower(s), old, new)
        return F.concat(F.lit("\x02"), F.trim(s), F.lit("\x02"))

    sentences = (*sentences, *PUBLISHED) if sentences is SENTENCES else sentences
    longest = sorted({x for _, x in sentences}, key=lambda x: (-len(x), x))
    found = rf"(?<=[\x01\x02])(?:{'|'.join(x.replace(' ', '[ \\x01]') for x in longest)}|{NOTICE})(?=[\x01\x02])"
    own = F.flatten(F.transform("s", lambda s: F.regexp_extract_all(norm(s), F.lit(found), F.lit(0))))
    own = F.transform(own, lambda m: F.regexp_replace(F.regexp_replace(m, "[\x01\x02]", " "), "^copyright .+ all rights reserved$",
                                                      "copyright notice"))
    d = d.select("doc_id", F.when(F.size("s") > 0, own).otherwise(F.array().cast("array<string>")).alias("s"))
    sentences = (*sentences, ("reserved-notice", "copyright notice"))
    known = F.create_map(*[F.lit(x) for i, s in sentences for x in (s, i)])
    d = d.select("doc_id", F.array_compact(F.transform("s", lambda s: F.try_element_at(known, s))).alias("ids"))
    d = d.select("doc_id", "ids", F.concat(F.lit("|"), F.array_join("ids", "||"), F.lit("|")).alias("line"))
    hits = F.array_distinct(F.array_compact(F.array(*[F.when(F.col("line").like(pattern(ids)), F.lit(name)) for name, ids in rules])))
    d = d.select("doc_id", "ids", hits.alias("hits")).withColumn("hits", F.when(
        (F.size("hits") == 0) & F.array_contains("ids", "reserved-notice"), F.array(F.lit("proprietary"))).otherwise(F.col("hits")))
    return d.select("doc_id", F.array_join("ids", ",").alias("sentence_ids"), F.array_join("hits", ",").alias("licenses"),
                    F.size("ids").cast("long").alias("n_sentences"), F.get("hits", F.lit(0)).alias("license"))


def query(spark, sf_dir):
    from .base import table
    return scan(table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    known = ", ".join(f"'{s}': '{i}'" for i, s in SENTENCES)
    hits = ", ".join(f"CASE WHEN line LIKE '{pattern(ids)}' THEN {k} END" for k, (_, ids) in enumerate(RULES))
    names = "[" + ", ".join(f"'{n}'" for n, _ in RULES) + "]"
    return rf"""
WITH s AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '[.!?;]+([ \t\r\n]|$)', chr(10), 'g'), '\n'),
                  lambda x: regexp_matches(x, '(?i){STEMS}')) AS s FROM documents),
n AS (SELECT doc_id, list_filter(list_transform(s, lambda x: map_extract_value(MAP {{{known}}},
             trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')))), lambda x: x IS NOT NULL) AS ids FROM s),
l AS (SELECT doc_id, ids, '|' || array_to_string(ids, '||') || '|' AS line FROM n),
h AS (SELECT doc_id, ids, list_transform(list_filter([{hits}], lambda x: x IS NOT NULL), lambda k: ({names})[k + 1]) AS h FROM l),
u AS (SELECT doc_id, ids, list_filter(h, lambda x, i: list_position(h, x) = i) AS h FROM h)
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string(h, ',') AS licenses,
       CAST(len(ids) AS BIGINT) AS n_sentences, h[1] AS license
FROM u
"""
