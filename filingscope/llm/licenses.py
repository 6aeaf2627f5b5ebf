"""Licence scan by sentence rules, in DataFrame and SQL functions only.

A text is normalised (lower case, letters, digits and single blanks) with marks where a sentence may begin and end: a
hard one at full stops, exclamation and question marks before white space and at blank lines (comment marks alone are
blank), a soft one at any other line break. Known licence sentences are looked for from mark to mark; soft marks
inside count as blanks, so that wrapped texts are found, and so does a sentence on a line of its own. Of sentences that begin
at the same place the longest counts. The known sentences have an identifier each. The identifiers of a text, in order, are then matched against licence rules, also in order:
a rule is a sequence of identifiers that must stand next to each other in the text's sequence (sentences that are not
known do not count); the first rules claim their sentences, so a full licence text goes before its parts.

Every known sentence holds one of the anchor words, so only texts with an anchor are normalised; that skips work,
not sentences. The SQL cuts at every line break, so it tells nothing about wrapped sentences; tests do. The tables of sentences and rules are fixed values of this module, of a few dozen entries.

Nulls: a null text has no sentences and no licence; a null ``doc_id`` stays null. Repeated rows give equal rows. An
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, texts

# Normalised licence sentences and their identifiers.
SENTENCES = {
    "released under the mit license": "mit_ref",
    "licensed under the mit license": "mit_ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "mit_warranty",
    "licensed under the apache license version 2 0": "apache2_ref",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
    "the license": "apache2_grant",
    "you may obtain a copy of the license at": "apache2_obtain",
    "this work is licensed under the gnu general public license version 3": "gpl3_ref",
    "this work is licensed under the gnu general public license version 2": "gpl2_ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 3 of the license or at your option "
    "any later version": "gpl3_grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 2 of the license or at your option "
    "any later version": "gpl2_grant",
    "you should have received a copy of the gnu general public license along with this program": "gpl_copy",
    "licensed under cc by nc 4 0": "cc_by_nc4_ref",
    "licensed under cc by 4 0": "cc_by4_ref",
    "licensed under cc by sa 4 0": "cc_by_sa4_ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc_by4_ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2_ref",
    "this is free and unencumbered software released into the public domain": "unlicense_ref",
    "all rights reserved": "reserved",
}

# Licences and the identifier sequences that show them, in the order in which they are tried.
RULES = (
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", ("apache2_grant", "apache2_obtain")),
    ("GPL-3.0-or-later", ("gpl3_grant", "gpl_copy")),
    ("GPL-2.0-or-later", ("gpl2_grant", "gpl_copy")),
    ("GPL-3.0-or-later", ("gpl3_grant",)),
    ("GPL-2.0-or-later", ("gpl2_grant",)),
    ("Apache-2.0", ("apache2_grant",)),
    ("Apache-2.0", ("apache2_ref",)),
    ("MIT", ("mit_ref",)),
    ("GPL-3.0", ("gpl3_ref",)),
    ("GPL-2.0", ("gpl2_ref",)),
    ("CC-BY-NC-4.0", ("cc_by_nc4_ref",)),
    ("CC-BY-SA-4.0", ("cc_by_sa4_ref",)),
    ("CC-BY-4.0", ("cc_by4_ref",)),
    ("MPL-2.0", ("mpl2_ref",)),
    ("Unlicense", ("unlicense_ref",)),
)

# Every known sentence holds one of these words.
ANCHORS = ("licens", "copyright", "permission", "warrant", "redistribut", "software", "reserved")

# Ends of known sentences that begin with a name, and the rules for them. The SQL lacks both.
ENDINGS = {
    "be used to endorse or promote products derived from this software without specific prior written "
    "permission": "bsd_names"
}
BSD_3 = ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names"))
ORDERED = (*RULES[:2], BSD_3, *RULES[2:])

# No capital is left in lower case, so these can be marks.
HARD, SOFT = "H", "S"


def _marked(text: Column) -> Column:
    """The normalised text with its marks; ``text`` is in lower case."""
    text = F.regexp_replace(text, r"[.!?]+(?:\s+|\z)", HARD)
    text = F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(SOFT)), "[^a-z0-9HS]+", " ")
    text = F.regexp_replace(F.concat(F.lit(HARD), text, F.lit(HARD)), " ?([HS]) ?", "$1")
    return F.regexp_replace(text, "[HS]{2,}", HARD)


def _pattern() -> str:
    wrapped = lambda sentence: sentence.replace(" ", "[ S]")
    whole = "|".join(wrapped(s) for s in sorted(SENTENCES, key=len, reverse=True))
    return f"(?:(?<=[HS])(?:{whole})|(?<=[HS ])(?:{'|'.join(wrapped(s) for s in ENDINGS)}))(?=[HS])"


def _anchored(text: Column) -> Column:
    found = [F.contains(text, F.lit(a)) for a in ANCHORS]
    return reduce(lambda a, b: a | b, found)


def scan(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``sentence_ids`` (known sentences in order), ``licenses`` (distinct, in the order of the
    rules), ``n_unmatched`` (known sentences that no rule claimed)."""
    lowered = F.lower("text")
    rows = texts(docs)
    found = F.regexp_extract_all(_marked(lowered), F.lit(_pattern()), F.lit(0))
    rows = rows.select("doc_id", F.when(_anchored(lowered), found).alias("found"))
    table = F.create_map(*[x for s, i in (SENTENCES | ENDINGS).items() for x in (F.lit(s), F.lit(i))])
    known = F.transform("found", lambda s: F.element_at(table, F.replace(s, F.lit(SOFT), F.lit(" "))))
    ids = F.filter(F.coalesce(known, F.array().cast("array<string>")), lambda i: i.isNotNull())
    rows = rows.select("doc_id", ids.alias("sentence_ids"))
    # Each identifier stands between two semicolons of its own; a claimed stretch becomes a bar and the rule's number.
    line = F.array_join(F.transform("sentence_ids", lambda i: F.concat(F.lit(";"), i, F.lit(";"))), "")
    for n, (_, sequence) in enumerate(ORDERED):
        line = F.replace(line, F.lit("".join(f";{i};" for i in sequence)), F.lit(f"|{n}|"))
    rows = rows.withColumn("claimed", line)
    hits = [F.when(F.contains(F.col("claimed"), F.lit(f"|{n}|")), F.lit(name)) for n, (name, _) in enumerate(ORDERED)]
    left = F.length("claimed") - F.length(F.replace(F.col("claimed"), F.lit(";"), F.lit("")))
    return rows.select(
        "doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join(F.array_distinct(F.array_compact(F.array(*hits))), ",").alias("licenses"),
        (left / 2).cast("long").alias("n_unmatched"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    table = "MAP {" + ", ".join(f"{quoted(s)}: {quoted(i)}" for s, i in SENTENCES.items()) + "}"
    line = "array_to_string(list_transform(ids, lambda i: ';' || i || ';'), '')"
    for n, (_, sequence) in enumerate(RULES):
        line = f"replace({line}, '{''.join(f';{i};' for i in sequence)}', '|{n}|')"
    hits = ", ".join(f"CASE WHEN contains(claimed, '|{n}|') THEN {quoted(name)} END" for n, (name, _) in enumerate(RULES))
    return f"""
    WITH cut AS (
      SELECT doc_id, list_transform(
        string_split_regex(lower(coalesce(text, '')), '\\n|[.!?]+(?:\\s+|$)'),
        lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))) AS sentences
      FROM documents),
    known AS (
      SELECT doc_id, list_filter(list_transform(sentences, lambda s: {table}[s]), lambda i: i IS NOT NULL) AS ids
      FROM cut),
    marked AS (SELECT doc_id, ids, {line} AS claimed FROM known),
    named AS (SELECT *, list_filter([{hits}], lambda h: h IS NOT NULL) AS names FROM marked)
    SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
      array_to_string(list_filter(names, lambda h, i: list_position(names, h) = i), ',') AS licenses,
      CAST((length(claimed) - length(replace(claimed, ';', ''))) / 2 AS BIGINT) AS n_unmatched
    FROM named"""


ORACLE = _sql()
