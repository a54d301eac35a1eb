"""License scans by sentence rules.

A text is normalised (lower case, runs of other characters than letters and
digits become one space) with marks where a sentence may begin or end: at line
ends and after ``.``, ``!``, ``?`` or ``;`` before a space; a known sentence may
also end at a colon, and the next one begin there.  Known licence sentences,
some of which have a variable part (a year, a name), are found between marks.
They may run over marks, so a sentence wrapped over lines is whole, but not over
a blank line; of two that begin at one place the longer counts.  The
identifiers of a text's known sentences, in their order, are then matched with
the licence rules in order: a rule is a sequence of identifiers that must occur
in this order; the first rule that matches takes its sentences, and the
remaining ones go on to the later rules.  Sentences that no rule takes make the
verdict ``UNKNOWN``.  An SPDX tag has one identifier (``spdx:mit``) for every
licence or exception that it names, each a rule of its own.

Texts without any of the words that every known sentence has one of hold no
known sentence, so they are not cut up.

Defined cases: a null, empty or licence-free text has no row in ``scan`` unless
``all_rows``; repeated rows report each; a null ``doc_id`` stays null; an empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import table

#: Known sentences in normal form, by identifier.
SENTENCES = {
    "the mit license mit": "mitTitle",
    "mit license": "mitTitle",
    "the mit license": "mitTitle",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mitAsIs",
    "apache license": "apacheTitle",
    "version 2 0 january 2004": "apacheVersion",
    "you may not use this file except in compliance with the license": "apacheComply",
    "you may obtain a copy of the license at": "apacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "apacheSee",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2Later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gplNoWarranty",
    "see the gnu general public license for more details": "gplSee",
    "licensed under cc by nc 4 0": "ccByNc4Ref",
    "licensed under cc by 4 0": "ccBy4Ref",
    "licensed under cc by sa 4 0": "ccBySa4Ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccBy4Ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccByNc4Ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccBySa4Ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsdEndorse",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2Ref",
    "this is free and unencumbered software released into the public domain": "unlicenseRef",
    "all rights reserved": "allRights",
}
#: Licences that a sentence "(this work is) licensed under (the terms of) the ..." may name, in normal form.
NAMED = {
    "mit license": "mitRef",
    "apache license version 2 0": "apacheRef",
    "apache license version 2 0 the license": "apacheRef",
    "apache license 2 0": "apacheRef",
    "gnu general public license version 3": "gpl3Ref",
    "gnu general public license version 2": "gpl2Ref",
    "gnu lesser general public license version 3": "lgpl3Ref",
    "gnu affero general public license version 3": "agpl3Ref",
    "bsd 3 clause license": "bsd3Ref",
    "bsd 2 clause license": "bsd2Ref",
    "mozilla public license version 2 0": "mpl2Ref",
}
#: What stands before the name (words are joined by the separator that the reader of the pattern puts in).
GRANTED = r"(?:this (?:project|work|software|code|library|program|file) is )?(?:licensed|released|distributed) under (?:the terms of )?the "
#: Known sentences with a variable part: (regular expression on the normal form, identifier).
PATTERNS = [
    (r"^spdx license identifier [a-z0-9 ]+$", "spdx"),
    (r"^copyright (?:c )?(?:[0-9]{4} )+.*$", "copyright"),
]
#: Rules in order: the licence and the identifiers that must follow each other.
RULES = [
    ("MIT", ["mitGrant", "mitNotice", "mitAsIs"]),
    ("Apache-2.0", ["apacheRef", "apacheComply", "apacheCopy", "apacheAsIs", "apacheSee"]),
    ("Apache-2.0", ["apacheTitle", "apacheVersion"]),
    ("GPL-3.0-or-later", ["gpl3Later", "gplNoWarranty", "gplSee"]),
    ("GPL-2.0-or-later", ["gpl2Later", "gplNoWarranty", "gplSee"]),
    ("BSD-3-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdEndorse"]),
    ("BSD-2-Clause", ["bsdGrant", "bsdSource", "bsdBinary"]),
    ("GPL-3.0-or-later", ["gpl3Later"]),
    ("GPL-2.0-or-later", ["gpl2Later"]),
    ("MIT", ["mitRef"]),
    ("Apache-2.0", ["apacheRef"]),
    ("AGPL-3.0", ["agpl3Ref"]),
    ("LGPL-3.0", ["lgpl3Ref"]),
    ("GPL-3.0", ["gpl3Ref"]),
    ("GPL-2.0", ["gpl2Ref"]),
    ("CC-BY-NC-4.0", ["ccByNc4Ref"]),
    ("CC-BY-SA-4.0", ["ccBySa4Ref"]),
    ("CC-BY-4.0", ["ccBy4Ref"]),
    ("BSD-3-Clause", ["bsd3Ref"]),
    ("BSD-2-Clause", ["bsd2Ref"]),
    ("MPL-2.0", ["mpl2Ref"]),
    ("Unlicense", ["unlicenseRef"]),
    ("Proprietary", ["allRights"]),
]
#: Ids of SPDX tags; a tag that names one in any spelling of its normal form (or with "-only") has it as its verdict.
SPDX = ["0BSD", "AFL-3.0", "AGPL-3.0", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0",
        "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2",
        "GPL-1.0", "GPL-1.0-or-later", "GPL-2.0", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-or-later", "ISC", "LGPL-2.0", "LGPL-2.0-or-later", "LGPL-2.1", "LGPL-2.1-or-later",
        "LGPL-3.0", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "NCSA", "OFL-1.1", "OpenSSL", "PostgreSQL", "Python-2.0", "Unlicense", "UPL-1.0", "WTFPL",
        "X11", "Zlib"]
#: Identifiers that support a rule but do not ask for a verdict of their own.
SILENT = ["copyright", "mitTitle"]
#: Every known sentence and pattern has one of these words.
KEYWORDS = ["licen", "copyright", "permission", "warrant", "permitted", "rights", "redistribut", "january", "endorse", "unencumbered"]
#: Steps from the lower-case text to the normal form: "|" marks a line or sentence end, "#" a blank line,
#: ":" a colon before a space ("/" is a line end until blank lines are known).
NORMAL = [
    # "GPL-2.0+" in a tag is "GPL-2.0-or-later"
    (r"(?<=[0-9])\+(?<=spdx-license-identifier:[^\n\r]{0,120}\+)", " or later"),
    (r"[|/#]+", " "),
    (r"([.!?;])[ \t]+", "$1|"),
    (r":(?![ \t])", " "),
    (r"\r\n?|\n", "/"),
    (r"[^a-z0-9|/:]+", " "),
    (r" ?([|/:]) ?", "$1"),
    (r"[|:]*/[|:]*/[|/:]*", "#"),
    (r"[|/:]*[|/][|/:]*|:{2,}", "|"),
]


def _known() -> str:
    """The expression that finds known sentences (its first group) in the normal form, longer ones first."""
    fixed = [k.replace(" ", "[ |:]") for k in sorted(SENTENCES, key=len, reverse=True)]
    granted = (GRANTED + "(?:" + "|".join(sorted(NAMED, key=len, reverse=True)) + ")").replace(" ", "[ |:]")
    declared = "licen[sc]e:(?:" + "|".join(sorted(_spdx(), key=len, reverse=True)) + ")"
    every = [granted, *fixed, r"spdx license identifier[ :][a-z0-9 ]+", declared, r"copyright (?:c )?(?:[0-9]{4} )+[^|#]*"]
    return r"(?:(?<=[|#])|\G:)(" + "|".join(every) + ")(?=[|#:])"


def _spdx() -> dict[str, str]:
    """The SPDX id by its normal form."""
    keys = {i.lower().replace("-", " ").replace(".", " "): i for i in SPDX}
    return keys | {f"{k} only": i for k, i in keys.items() if "GPL" in i and not k.endswith("later")}


def known_sentences(text: Column) -> Column:
    """Identifiers of the known sentences of ``text``, in order (null for texts without a keyword)."""
    ids = F.create_map(*[F.lit(x) for pair in [*SENTENCES.items(), *((f"granted {k}", v) for k, v in NAMED.items())] for x in pair])
    normal = F.concat(F.lit("\n"), F.lower(text), F.lit("\n"))
    for pattern, mark in NORMAL:
        normal = F.regexp_replace(normal, pattern, mark)
    found = F.regexp_extract_all(normal, F.lit(_known()), F.lit(1))

    def identify(sentence: Column) -> Column:
        named = F.regexp_replace(sentence, "^(?:spdx license identifier[ :]|licen[sc]e:)", "")
        tags = F.transform(F.split(named, " (?:or(?! later\\b)|and|with) "), lambda x: F.concat(F.lit("spdx:"), x))
        plain = F.regexp_replace(F.translate(sentence, "|:", "  "), "^" + GRANTED, "granted ")
        other = F.array(F.coalesce(F.try_element_at(ids, plain), F.lit("copyright")))
        return F.when(named != sentence, tags).otherwise(other)

    return F.when(F.lower(text).rlike("|".join(KEYWORDS)), F.flatten(F.transform(found, identify)))


def tagged(name: Column) -> Column:
    """The licence that the identifier of an SPDX tag names (null for other identifiers and unknown ids)."""
    return F.try_element_at(F.create_map(*[F.lit(x) for k, i in _spdx().items() for x in (f"spdx:{k}", i)]), name)


def match_rules(ids: Column) -> Column:
    """``struct(rest, found)``: identifiers that no rule took, and the licences in rule order.

    A rule walks the sequence once: each of its identifiers is looked for behind the one
    before it, so the work is linear in the sentences.  A sequence in which the
    earliest places do not do has no other that does.
    """
    state = F.struct(ids.alias("rest"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*[F.struct(F.lit(seq).alias("seq"), F.lit(name).alias("name")) for name, seq in RULES])

    def walk(rest: Column, seq: Column) -> Column:
        """Places (from 1) that the rule takes; a 0 ends them where an identifier is missing."""
        def next_place(places: Column, name: Column) -> Column:
            last = F.when(F.size(places) == 0, F.lit(0)).otherwise(F.element_at(places, -1))
            behind = F.array_position(F.slice(rest, last + 1, F.greatest(F.size(rest) - last, F.lit(0))), name).cast("int")
            step = F.when(F.array_contains(places, 0) | (behind == 0), F.lit(0)).otherwise(last + behind)
            return F.concat(places, F.array(step))
        return F.aggregate(seq, F.array().cast("array<int>"), next_place)

    def step(acc: Column, rule: Column) -> Column:
        places = walk(acc["rest"], rule["seq"])
        hit = ~F.array_contains(places, 0)
        rest = F.filter(acc["rest"], lambda _, i: ~F.array_contains(places, i + 1))
        return F.struct(F.when(hit, rest).otherwise(acc["rest"]).alias("rest"),
                        F.when(hit, F.concat(acc["found"], F.array(rule["name"]))).otherwise(acc["found"]).alias("found"))

    return F.aggregate(rules, state, step)


def scan(docs: DataFrame, keep: list[str] | None = None, all_rows: bool = False) -> DataFrame:
    """``(keep..., sentences, licenses, unknown)`` of the rows with a known sentence (of all rows with ``all_rows``)."""
    keep = keep or ["doc_id"]
    rows = docs.select(*keep, known_sentences(F.col("text")).alias("sentences"))
    if not all_rows:
        rows = rows.where(F.size("sentences") > 0)
    rows = rows.withColumn("sentences", F.coalesce("sentences", F.array().cast("array<string>")))
    rows = rows.withColumn("m", match_rules(F.col("sentences")))
    asked = [x for x in {*SENTENCES.values(), *NAMED.values(), *(n for _, n in PATTERNS)} if x not in SILENT]
    # a sentence left over asks for no verdict when it belongs to a licence that was found
    homes = {i: sorted({name for name, seq in RULES if i in seq}) for i in asked}
    home = F.create_map(*[x for i, names in homes.items() for x in (F.lit(i), F.lit(names) if names else F.array().cast("array<string>"))])
    found = F.concat("m.found", F.array_compact(F.transform("sentences", tagged)))
    # "all rights reserved" stands in the header of many licences: alone it means none
    found = F.when(F.exists(found, lambda x: x != "Proprietary"), F.array_remove(found, "Proprietary")).otherwise(found)
    rows = rows.withColumn("l", found)
    unknown = F.exists("m.rest", lambda x: x.isin(sorted(asked)) & ~F.arrays_overlap(F.try_element_at(home, x), F.col("l")))
    unknown = unknown | F.exists("sentences", lambda x: x.startswith("spdx:") & tagged(x).isNull())
    return rows.select(*keep, "sentences", F.array_sort(F.array_distinct("l")).alias("licenses"), unknown.alias("unknown"))


def op9_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document with a known licence sentence: the sentences, the verdicts, and how many sentences there are."""
    rows = scan(table(spark, sf_dir, "documents"))
    verdict = F.when(F.size("licenses") > 0, F.array_join("licenses", ",")).otherwise(F.lit("UNKNOWN"))
    return rows.select("doc_id", F.array_join("sentences", ",").alias("sentence_ids"), verdict.alias("licenses"), F.size("sentences").cast("long").alias("n_sentences"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql() -> str:
    # The SQL cuts at every line end: it states the query for texts with each known sentence on one line
    # and without SPDX tags or "License: id" lines; a plain-Python twin in the tests states those.
    pairs = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in [*SENTENCES.items(), *((f"granted {k}", v) for k, v in NAMED.items())])
    patterns = " ".join(f"WHEN regexp_matches(s.norm, {_quoted(p)}) THEN {_quoted(n)}" for p, n in PATTERNS)
    steps, prev = [], "joined"
    for i, (name, seq) in enumerate(RULES):
        pat = _quoted("".join(f"([^!]*?)\\|{x}\\|" for x in seq))
        left = _quoted("".join(f"\\{k + 1}" for k in range(len(seq))))
        steps.append(f"r{i} AS (SELECT doc_id, row, ids, n, CASE WHEN regexp_matches(rest, {pat}) THEN regexp_replace(rest, {pat}, {left}) ELSE rest END AS rest, "
                     f"CASE WHEN regexp_matches(rest, {pat}) THEN list_append(found, {_quoted(name)}) ELSE found END AS found FROM {prev})")
        prev = f"r{i}"
    return f"""
WITH known(norm, name) AS (VALUES {pairs}),
d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents WHERE text IS NOT NULL),
s0 AS (SELECT row, doc_id, unnest(string_split_regex(regexp_replace(text, '([.!?;])[ \\t]+', '\\1' || chr(10), 'g'), '[\\n\\r]+')) AS sentence,
              generate_subscripts(string_split_regex(regexp_replace(text, '([.!?;])[ \\t]+', '\\1' || chr(10), 'g'), '[\\n\\r]+'), 1) AS k FROM d),
s AS (SELECT row, doc_id, k, regexp_replace(trim(regexp_replace(lower(sentence), '[^a-z0-9]+', ' ', 'g')), {_quoted('^' + GRANTED)}, 'granted ') AS norm FROM s0),
named AS (SELECT s.row, s.doc_id, s.k, coalesce(known.name, CASE {patterns} END) AS name FROM s LEFT JOIN known ON s.norm = known.norm),
joined AS (SELECT doc_id, row, string_agg(name, ',' ORDER BY k) AS ids, count(*) AS n, '|' || string_agg(name, '||' ORDER BY k) || '|' AS rest, []::VARCHAR[] AS found
           FROM named WHERE name IS NOT NULL GROUP BY doc_id, row),
{", ".join(steps)}
SELECT doc_id, ids AS sentence_ids, CASE WHEN len(found) > 0 THEN array_to_string(list_sort(list_distinct(found)), ',') ELSE 'UNKNOWN' END AS licenses,
       n AS n_sentences FROM (SELECT doc_id, ids, n, CASE WHEN len(list_filter(found, lambda x: x <> 'Proprietary')) > 0 THEN list_filter(found, lambda x: x <> 'Proprietary') ELSE found END AS found FROM {prev})
"""


SQL = _sql()
