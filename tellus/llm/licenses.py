"""Licence scans by sentence rules, with DataFrame functions only.

A text is cut into sentences, each is normalised, and a normalised sentence
that is known maps to a licence-sentence identifier. The identifiers of a
text, in order, form a sequence; a licence is found where an ordered rule
matches: its identifiers occur in this order with at most ``MAX_GAP``
unknown sentences between two of them.

Sentence ends: a blank line, or one of ``. ! ? ; :`` before white space. A
single line feed is a space, and so are the comment signs that a line starts
with, so wrapped texts and commented headers read as they are meant.
Normal form: lower case, runs of anything but letters, digits and ``.+-/()``
become one space, dots and spaces at the ends go. A sentence without a letter
(the number of a list item) does not count.

A rule gives way where one that says more is found (``GIVES_WAY``): "all
rights reserved" is proprietary only where nothing is granted.

Defined cases: a null or empty text has no sentence and no licence; rows are
independent, so repeated rows, null ids and extra columns do no harm; whole
texts are read, however long.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tellus.llm.common import text_or_empty

#: Unknown sentences allowed between two identifiers of a rule.
MAX_GAP = 2

#: Every known sentence has one of these words; a text without any is not
#: cut into sentences at all.
HINT = "licen[cs]e|copyright|permission|warrant|redistribut|endorse|applicable|unencumbered|reserved"

# Known licence sentences, by identifier, as patterns that a
# whole normalised sentence has to match. The first that matches counts.
SENTENCES = [
    ("APACHE2", r"(.* )?licen[cs]ed under (the )?apache licen[cs]e,?( version)? 2(.0)?.*"),
    ("APACHE2URL", r".*www.apache.org/licenses/license-2.0.*"),
    ("APACHE2COMPLY", r"(.* )?you may not use this (file|work|software) except in compliance with the licen[cs]e.*"),
    ("ASISLAW", r"unless required by applicable law or agreed to in writing.*as is.*"),
    ("AGPL3", r".*gnu affero general public licen[cs]e.*"),
    ("LGPL", r".*gnu (lesser|library) general public licen[cs]e.*"),
    ("GPL2", r".*gnu general public licen[cs]e( as published by the free software foundation)?( (either )?version| v)? ?2.*"),
    ("GPL3", r".*gnu general public licen[cs]e( as published by the free software foundation)?( (either )?version| v)? ?3.*"),
    ("GPL", r".*gnu general public licen[cs]e.*"),
    ("MIT", r"(.* )?(released|licen[cs]ed|distributed|available) under (the )?(terms of the )?mit licen[cs]e.*"),
    ("MITTITLE", r"(the )?mit licen[cs]e( \(mit\))?( copyright.*)?"),
    ("MITPERM", r"(.* )?permission is hereby granted free of charge to any person obtaining a copy.*"),
    ("MITNOTICE", r"(.* )?the above copyright notice and this permission notice shall be included in all copies.*"),
    ("ASIS", r".*the software is provided as is.*without warranty of any kind.*"),
    ("ISCPERM", r"(.* )?permission to use copy modify and(/or)? distribute this software for any purpose.*"),
    ("BSDPERM", r"(.* )?redistribution and use in source and binary forms.*are permitted.*"),
    ("BSDSOURCE", r"(\(?[1a]\)?.? )?redistributions of source code must retain the above copyright notice.*"),
    ("BSDBINARY", r"(\(?[2b]\)?.? )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("BSDNAME", r"(\(?[3c]\)?.? )?neither the name of .*may be used to endorse or promote.*"),
    ("BSD", r"(.* )?(released|licen[cs]ed|distributed) under (the |a )?(2-clause |3-clause |new |simplified )?bsd.* licen[cs]e.*"),
    ("CCBYNCND", r"(.* )?licen[cs]ed under (a )?(cc|creative commons) by-nc-nd.*"),
    ("CCBYNCSA", r"(.* )?licen[cs]ed under (a )?(cc|creative commons) by-nc-sa.*"),
    ("CCBYNC", r"(.* )?licen[cs]ed under (a )?(cc|creative commons) by-nc.*"),
    ("CCBYND", r"(.* )?licen[cs]ed under (a )?(cc|creative commons) by-nd.*"),
    ("CCBYSA", r"(.* )?licen[cs]ed under (a )?(cc|creative commons) by-sa.*"),
    ("CCBY", r"(.* )?licen[cs]ed under (a )?(cc|creative commons) by.*"),
    ("MPL2", r".*mozilla public licen[cs]e,? (version |v. ?)?2.0.*"),
    ("UNLICENSE", r"this is free and unencumbered software released into the public domain"),
    ("GPLV2", r"(either )?version 2 of the licen[cs]e.*"),
    ("GPLV3", r"(either )?version 3 of the licen[cs]e.*"),
    ("RESERVED", r"(.* )?all rights reserved( .*)?"),
]

# Ordered rules, as (licence, kind, identifiers in order).
RULES = [
    ("Apache-2.0", "permissive", ["APACHE2"]),
    ("Apache-2.0-notice", "permissive", ["APACHE2", "APACHE2COMPLY", "APACHE2URL", "ASISLAW"]),
    ("MIT", "permissive", ["MIT"]),
    ("MIT-text", "permissive", ["MITPERM", "MITNOTICE", "ASIS"]),
    ("ISC", "permissive", ["ISCPERM"]),
    ("BSD", "permissive", ["BSD"]),
    ("BSD-2-Clause", "permissive", ["BSDPERM", "BSDSOURCE", "BSDBINARY"]),
    ("BSD-3-Clause", "permissive", ["BSDPERM", "BSDSOURCE", "BSDBINARY", "BSDNAME"]),
    ("CC-BY", "permissive", ["CCBY"]),
    ("Unlicense", "permissive", ["UNLICENSE"]),
    ("GPL", "copyleft", ["GPL"]),
    ("GPL-2.0", "copyleft", ["GPL2"]),
    ("GPL-3.0", "copyleft", ["GPL3"]),
    ("LGPL", "copyleft", ["LGPL"]),
    ("AGPL-3.0", "copyleft", ["AGPL3"]),
    ("MPL-2.0", "copyleft", ["MPL2"]),
    ("CC-BY-SA", "copyleft", ["CCBYSA"]),
    ("CC-BY-ND", "restricted", ["CCBYND"]),
    ("CC-BY-NC", "restricted", ["CCBYNC"]),
    ("CC-BY-NC-SA", "restricted", ["CCBYNCSA"]),
    ("CC-BY-NC-ND", "restricted", ["CCBYNCND"]),
    ("Proprietary", "restricted", ["RESERVED"]),
]

RULES += [("GPL-2.0", "copyleft", ["GPL", "GPLV2"]), ("GPL-3.0", "copyleft", ["GPL", "GPLV3"])]

#: A licence that does not count where one of these is found.
GIVES_WAY = {"BSD-2-Clause": ["BSD-3-Clause"], "GPL": ["GPL-2.0", "GPL-3.0"],
             "Proprietary": sorted({name for name, _, _ in RULES} - {"Proprietary"})}

#: Kinds, the strictest first.
KINDS = ["restricted", "copyleft", "permissive"]


#: What is done to a text, in order, before it is cut at blank lines.
UNWRAP = [(r"[ \t\r]+", " "), (r"\*/", " "), (r" ?\n ?([/*#;%!<>-]+ ?)?", "\n"), (r"([.!?;:])[ \n]+", "$1\n\n")]
#: And to each sentence, in lower case.
NORMAL = [(r"[^a-z0-9.+/()-]+", " "), (r"[. ]{2,}", " "), (r"^[. ]|[. ]$", "")]


def sentences(text: Column) -> Column:
    """The sentences of a text, as written."""
    for pattern, by in UNWRAP:
        text = F.regexp_replace(text, pattern, by)
    return F.split(text, "\n\n+")


def normal_form(sentence: Column) -> Column:
    s = F.lower(sentence)
    for pattern, by in NORMAL:
        s = F.regexp_replace(s, pattern, by)
    return s


def sentence_id(normal: Column) -> Column:
    """The identifier of a normalised sentence; null if it is not known."""
    known = F.coalesce(*[F.when(normal.rlike(f"^(?:{p})$"), F.lit(name)) for name, p in SENTENCES])
    return F.when(normal.rlike(HINT), known)


def rule_pattern(ids: list[str]) -> str:
    """A pattern over a sequence text: each identifier ends in a space, and
    ``| `` stands where too many unknown sentences lie between two."""
    return "(^| )" + "([A-Z0-9]+ )*".join(f"{i} " for i in ids)


#: Each licence and its kind.
LICENSES = {name: kind for name, kind, _ in RULES}


def _holds(name: str, matches: Callable[[str], Column]) -> Column:
    """Whether one of the licence's rules matches and nothing it gives way to."""
    def found(names: list[str]) -> Column:
        return matches("|".join(rule_pattern(ids) for n, _, ids in RULES if n in names))
    return found([name]) & ~found(GIVES_WAY[name]) if name in GIVES_WAY else found([name])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_gap: int = MAX_GAP) -> DataFrame:
    """Per row: id, sentence_ids (array<struct<sentence, id>>: the place of
    the sentence from 0, and its identifier), sequence (text), licenses
    (sorted array), kind (the strictest of the licences found; ``unknown`` if
    there are licence sentences but no rule matches, else ``none``)."""
    text = text_or_empty(F.col(text_col))
    d = docs.select(F.col(id_col), F.when(F.lower(text).rlike(HINT), sentences(text)).otherwise(F.array().cast("array<string>")).alias("s"))
    d = d.withColumn("s", F.filter(F.transform("s", normal_form), lambda x: x.rlike("[a-z]")))
    ids = F.transform("s", lambda x, i: F.struct(i.cast("int").alias("sentence"), sentence_id(x).alias("id")))
    d = d.select(id_col, F.filter(ids, lambda x: x["id"].isNotNull()).alias("sentence_ids"))

    def item(x: Column, i: Column) -> Column:
        last = F.get(F.col("sentence_ids"), i - 1)["sentence"]
        return F.concat(F.when(x["sentence"] - last - 1 > max_gap, "| ").otherwise(""), x["id"], F.lit(" "))
    d = d.withColumn("sequence", F.array_join(F.transform("sentence_ids", item), ""))
    hits = F.array(*[F.when(_holds(name, lambda p: F.col("sequence").rlike(p)), F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind")))
                     for name, kind in LICENSES.items()])
    d = d.withColumn("hits", F.when(F.col("sequence") == "", F.array().cast("array<struct<name:string,kind:string>>"))
                     .otherwise(F.filter(hits, lambda x: x.isNotNull())))
    kinds = F.transform("hits", lambda x: x["kind"])
    kind = reduce(lambda c, k: c.when(F.array_contains(kinds, k), k), KINDS, F.when(F.lit(False), ""))
    return d.select(id_col, "sentence_ids", "sequence",
                    F.array_sort(F.transform("hits", lambda x: x["name"])).alias("licenses"),
                    kind.when(F.col("sequence") != "", "unknown").otherwise("none").alias("kind"))


def oracle_sql(max_gap: int = MAX_GAP) -> str:
    """The same scan in DuckDB SQL, from the same fixed values."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    case = " ".join(f"WHEN regexp_full_match(n, {q(p)}) THEN {q(name)}" for name, p in SENTENCES)
    def found(names: list[str]) -> str:
        return f"regexp_matches(q, {q('|'.join(rule_pattern(ids) for n, _, ids in RULES if n in names))})"

    def holds(name: str) -> str:
        return found([name]) + (f" AND NOT {found(GIVES_WAY[name])}" if name in GIVES_WAY else "")

    def replaced(x: str, steps: list[tuple[str, str]]) -> str:
        for pattern, by in steps:
            x = f"regexp_replace({x}, {q(pattern)}, {q(by.replace('$1', chr(92) + '1'))}, 'g')"
        return x
    hits = ", ".join(f"CASE WHEN {holds(name)} THEN {q(name)} END" for name in LICENSES)
    kinds = " ".join(f"WHEN {' OR '.join(f'({holds(name)})' for name, k in LICENSES.items() if k == kind)} THEN {q(kind)}" for kind in KINDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, regexp_split_to_array({replaced('text', UNWRAP)}, '\n\n+') AS l FROM d),
u AS (SELECT r, unnest(l) AS x, generate_subscripts(l, 1) AS j FROM s),
m AS (SELECT r, j, {replaced('lower(x)', NORMAL)} AS n FROM u),
n AS (SELECT r, n, row_number() OVER (PARTITION BY r ORDER BY j) - 1 AS i FROM m WHERE regexp_matches(n, '[a-z]')),
k AS (SELECT r, i, CASE {case} END AS id FROM n WHERE regexp_matches(n, {q(HINT)})),
g AS (SELECT r, i, id, i - lag(i) OVER (PARTITION BY r ORDER BY i) - 1 AS gap FROM k WHERE id IS NOT NULL),
t AS (SELECT r, string_agg(CASE WHEN gap > {max_gap} THEN '| ' ELSE '' END || id || ' ', '' ORDER BY i) AS q,
             count(*) AS c, min(i) AS f FROM g GROUP BY r)
SELECT doc_id, coalesce(c, 0)::BIGINT AS n_license_sentences, coalesce(f, -1)::INT AS first_sentence, coalesce(t.q, '') AS sequence,
       CASE WHEN t.q IS NULL THEN '' ELSE array_to_string(list_sort(list_filter([{hits}], lambda x: x IS NOT NULL)), ',') END AS licenses,
       CASE WHEN t.q IS NULL THEN 'none' {kinds} ELSE 'unknown' END AS kind
FROM d LEFT JOIN t USING (r)"""
