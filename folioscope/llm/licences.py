"""Licence scans by sentence rules (DataFrame functions only).

Known licence sentences have identifiers; a rule is an ordered list of them that
names a licence, and may name sentences that rule it out. A text is cut into
sentences in two ways: at sentence ends and line ends, and at sentence ends, blank
lines and colons that end a line, so that both one-line notices and wrapped
paragraphs are seen. A sentence ends at ``.``, ``;``, ``!`` or ``?`` before white
space, but not behind a single character (``v. 2.0``). Sentences are normalised (A-Z
lower-cased, runs of other than letters a-z and digits to one space, a leading number
dropped) and looked up. A licence is found if the identifiers of its rule occur in
this order in either sequence; other known sentences may stand between them.

An SPDX line is a sentence with an identifier for each licence of its expression; an
unknown name in it names nothing. Only sentences that hold a cue word are looked up;
every known one does.

A rule is matched by one pass over the identifiers that advances a pointer per rule,
so the work is in proportion to the text.

Defined cases: a null or empty text has no sentences and no licences. Repeated
rows give repeated results. An empty table gives an empty result. Columns other
than the two named are ignored.
"""

from __future__ import annotations

import re
import string
from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of licences as notices use them.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, Version 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"),
    "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "OFL-1.1": ("SIL Open Font License, Version 1.1",),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}

#: How notices begin.
OPENINGS = ("Licensed", "Released", "Distributed", "This work is licensed", "This project is licensed", "This software is licensed", "This software is released", "This code is licensed")

#: The Creative Commons terms by their code.
COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

#: Licences known by their SPDX name besides those above.
OTHER_NAMES = ("0BSD", "Artistic-2.0", "CC0-1.0", "EUPL-1.2", "MS-PL", "NCSA", "PostgreSQL", "Python-2.0")

#: Sentences of public licence texts and headers, by identifier.
SENTENCES = {
    "agpl3.grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache2.grant": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache2.use": "you may not use this file except in compliance with the License.",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd.endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd.warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "boost.grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "gnu.gpl": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gnu.lgpl": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "gnu.version2": "either version 2 of the License, or (at your option) any later version.",
    "gnu.version2.1": "either version 2.1 of the License, or (at your option) any later version.",
    "gnu.version3": "either version 3 of the License, or (at your option) any later version.",
    "gpl3.grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gnu.warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl2.warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "lgpl3.grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit.notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit.warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mpl2.notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc0.notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense.domain": "This is free and unencumbered software released into the public domain.",
    "zlib.grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}

#: Ordered rules (licence, sentences in order, sentences that rule it out).
RULES = (
    ("AGPL-3.0", ("agpl3.grant",), ()),
    ("Apache-2.0", ("apache2.grant", "apache2.use"), ()),
    ("BSD-2-Clause", ("bsd.grant", "bsd.warranty"), ("bsd.endorse",)),
    ("BSD-3-Clause", ("bsd.grant", "bsd.endorse", "bsd.warranty"), ()),
    ("BSL-1.0", ("boost.grant",), ()),
    ("CC0-1.0", ("cc0.notice",), ()),
    ("GPL-2.0", ("gnu.gpl", "gnu.version2", "gnu.warranty"), ()),
    ("GPL-3.0", ("gpl3.grant", "gnu.warranty"), ()),
    ("GPL-3.0", ("gnu.gpl", "gnu.version3", "gnu.warranty"), ()),
    ("ISC", ("isc.grant",), ()),
    ("LGPL-2.1", ("gnu.lgpl", "gnu.version2.1", "lgpl2.warranty"), ()),
    ("LGPL-3.0", ("lgpl3.grant", "gnu.warranty"), ()),
    ("MIT", ("mit.grant", "mit.notice", "mit.warranty"), ()),
    ("MPL-2.0", ("mpl2.notice",), ()),
    ("Unlicense", ("unlicense.domain",), ()),
    ("Zlib", ("zlib.grant",), ()),
)

CUES = ("licen", "permi", "warrant", "redistribut", "copyright", "public domain", "creative commons", "cc by", "cc-by")
_CUE = "|".join("".join(f"[{c}{c.upper()}]" if c != " " else " " for c in cue) for cue in CUES)
_END = "([^ \\t\\r\\n][^ \\t\\r\\n.;!?][.;!?])[ \\t\\r\\n]+"
SPDX = "spdx license identifier "


def normal_form(sentence: str) -> str:
    low = sentence.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return re.sub("^[0-9]+ ", "", re.sub("[^a-z0-9]+", " ", low).strip(" "))


def notices() -> dict[str, str]:
    """Sentences that name a licence alone, and the licence: by opening and name, and by SPDX name."""
    found = {f"{opening} under the {name}.": licence for licence, names in NAMES.items() for opening, name in product(OPENINGS, names)}
    for code, terms in COMMONS.items():
        for opening, short in product(OPENINGS, (f"CC {code} 4.0", f"CC-{code}-4.0")):
            found[f"{opening} under {short}."] = f"CC-{code}-4.0"
        for opening, end in product(OPENINGS, ("International License", "International")):
            found[f"{opening} under a Creative Commons {terms} 4.0 {end}."] = f"CC-{code}-4.0"
    for licence in (*NAMES, *OTHER_NAMES, *(f"CC-{code}-4.0" for code in COMMONS)):
        gnu = ("-only", "-or-later", "+") if "GPL" in licence else ()
        found |= {f"SPDX-License-Identifier: {licence}{end}": licence for end in ("", *gnu)}
    return found


def tables(sentences: dict[str, str] = SENTENCES, rules=RULES) -> tuple[dict[str, str], dict[str, str], tuple]:
    """Normal form to identifier, identifier to licence for sentences that name one alone, and the rules of several."""
    alone = {ids[0]: licence for licence, ids, unless in rules if len(ids) == 1 and not unless}
    known = {normal_form(s): key for key, s in sentences.items()}
    for sentence, licence in notices().items():
        key = known.setdefault(normal_form(sentence), f"notice.{licence}")
        alone.setdefault(key, licence)
    return known, alone, tuple(r for r in rules if len(r[1]) > 1 or r[2])


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _identified(sentences: Column, known: dict[str, str]) -> Column:
    """The identifiers of the known ones among sentences, in order."""
    lookup = _map(known)

    def form(s: Column) -> Column:
        plain = F.btrim(F.regexp_replace(F.translate(s, string.ascii_uppercase, string.ascii_lowercase), "[^a-z0-9]+", " "))
        return F.regexp_replace(plain, "^[0-9]+ ", "")

    def expression(f: Column) -> Column:
        """The forms of an SPDX line's licences, each as if it stood alone; other sentences unchanged."""
        names = F.regexp_replace(F.substring(f, len(SPDX) + 1, 1 << 20), " with .*$", "")
        parts = F.split(F.regexp_replace(names, " or later", " orlater"), " (or|and) ")
        return F.when(f.startswith(SPDX), F.transform(parts, lambda p: F.concat(F.lit(SPDX), F.regexp_replace(p, " orlater", " or later")))).otherwise(F.array(f))

    forms = F.flatten(F.transform(F.filter(sentences, lambda s: s.rlike(_CUE)), lambda s: expression(form(s))))
    return F.filter(F.transform(forms, lambda f: F.element_at(lookup, f)), lambda i: i.isNotNull())


def _named(ids: Column, alone: dict[str, str], rules: tuple) -> Column:
    """The licences that a sequence of identifiers names."""
    single = F.filter(F.transform(ids, lambda i: F.element_at(_map(alone), i)), lambda x: x.isNotNull())
    if not rules:
        return single
    steps = F.array(*[F.array(*[F.lit(i) for i in own]) for _, own, _ in rules])
    members = F.array(*[F.lit(i) for i in dict.fromkeys(i for _, own, _ in rules for i in own)])
    reached = F.aggregate(
        F.filter(ids, lambda i: F.array_contains(members, i)),
        F.array_repeat(F.lit(0), len(rules)),
        lambda state, i: F.zip_with(state, steps, lambda at, own: F.when(F.get(own, at) == i, at + 1).otherwise(at)),
    )
    ends = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit(len(own)).alias("length"), F.array(*[F.lit(i) for i in unless]).cast("array<string>").alias("unless")) for licence, own, unless in rules])
    several = F.zip_with(reached, ends, lambda at, rule: F.when((at == rule["length"]) & ~F.arrays_overlap(ids, rule["unless"]), rule["licence"]))
    return F.concat(single, F.filter(several, lambda x: x.isNotNull()))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """(doc_id, licences, n_sentences, sentence_ids): licences sorted, ids in text order by the line-wise cut."""
    known, alone, several = tables(sentences, rules)
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_line = F.split(F.regexp_replace(text, _END, "$1\n"), "\n")
    marked = F.regexp_replace(F.regexp_replace(text, "\n[ \t\r]*\n", "\u001e"), ":[ \t\r]*\n", ":\u001e")
    unwrapped = F.regexp_replace(F.regexp_replace(marked, "[ \t\r\n]+", " "), _END, "$1\n")
    by_paragraph = F.split(F.translate(unwrapped, "\u001e", "\n"), "\n")
    none = F.array().cast("array<string>")
    # A plain search of the lower-cased text spares all others the patterns.
    cued = reduce(or_, (F.col("low").contains(cue) for cue in CUES))
    cut = docs.withColumn("low", F.lower(text)).select(F.col(id_col).alias("doc_id"), F.when(cued, by_line).otherwise(none).alias("lines"), F.when(cued, by_paragraph).otherwise(none).alias("paragraphs"))
    rows = cut.select("doc_id", _identified(F.col("lines"), known).alias("sentence_ids"), _identified(F.col("paragraphs"), known).alias("wrapped_ids"))
    found = F.concat(*[F.when(F.size(c) > 0, _named(F.col(c), alone, several)).otherwise(none) for c in ("sentence_ids", "wrapped_ids")])
    return rows.select("doc_id", F.array_sort(F.array_distinct(found)).alias("licences"), F.size("sentence_ids").cast("long").alias("n_sentences"), "sentence_ids")


def op8_licences(spark, sf_dir: str) -> DataFrame:
    result = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return result.select("doc_id", F.array_join("licences", ",").alias("licences"), "n_sentences", F.array_join("sentence_ids", " ").alias("sentence_ids"))


def _oracle() -> str:
    """SQL from the raw sentences and rules; it cuts, normalises, looks up and matches on its own, by joins."""

    def rows(values) -> str:
        return ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x) for x in v) + ")" for v in values)

    alone = {ids[0]: licence for licence, ids, unless in RULES if len(ids) == 1 and not unless}
    known = [(key, s, alone.get(key, "")) for key, s in SENTENCES.items()] + [(f"notice.{licence}", s, licence) for s, licence in notices().items()]
    steps = [(n, licence, k, i, len(ids)) for n, (licence, ids, unless) in enumerate(RULES) if len(ids) > 1 or unless for k, i in enumerate(ids)]
    unless = [(n, i) for n, (_, _, not_with) in enumerate(RULES) for i in not_with]
    form = "regexp_replace(trim(regexp_replace(lower(regexp_replace({0}, '[^A-Za-z0-9]+', ' ', 'g')), ' +', ' ', 'g'), ' '), '^[0-9]+ ', '')"
    end = r"([^ \t\r\n][^ \t\r\n.;!?][.;!?])[ \t\r\n]+"
    return rf"""
WITH RECURSIVE raw(id, sentence, licence) AS (VALUES {rows(known)}),
known AS (SELECT form, min(id) AS id, max(licence) AS licence FROM (SELECT {form.format("sentence")} AS form, id, licence FROM raw) GROUP BY form),
steps(rule, licence, step, id, n) AS (VALUES {rows(steps)}),
unless(rule, id) AS (VALUES {rows(unless)}),
cut AS (SELECT doc_id, 0 AS way, regexp_split_to_array(regexp_replace(coalesce(text, ''), '{end}', '\1' || chr(10), 'g'), '\n') AS s FROM documents
  UNION ALL SELECT doc_id, 1, regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\n[ \t\r]*\n', chr(30), 'g'), ':[ \t\r]*\n', ':' || chr(30), 'g'), '[ \t\r\n]+', ' ', 'g'), '{end}', '\1' || chr(10), 'g'), '[\n\x1e]') FROM documents),
lines AS (SELECT doc_id, way, unnest(range(len(s))) AS pos, unnest(s) AS line FROM cut),
cued AS (SELECT doc_id, way, pos, {form.format("line")} AS form FROM lines WHERE regexp_matches(line, '(?i)licen|permi|warrant|redistribut|copyright|public domain|creative commons|cc by|cc-by')),
parts AS (SELECT doc_id, way, pos, 0 AS part, form FROM cued WHERE NOT starts_with(form, '{SPDX}')
  UNION ALL SELECT doc_id, way, pos, unnest(range(len(p))), '{SPDX}' || replace(unnest(p), ' orlater', ' or later')
  FROM (SELECT doc_id, way, pos, regexp_split_to_array(replace(regexp_replace(substr(form, {len(SPDX) + 1}), ' with .*$', ''), ' or later', ' orlater'), ' (or|and) ') AS p FROM cued WHERE starts_with(form, '{SPDX}'))),
found AS (SELECT doc_id, way, pos * 1000000 + part AS pos, id, licence FROM parts JOIN known USING (form)),
walk AS (SELECT DISTINCT doc_id, way, rule, steps.licence, 0 AS step, n, -1::BIGINT AS pos FROM found, steps WHERE found.id = steps.id AND steps.step = 0
  UNION ALL SELECT w.doc_id, w.way, w.rule, w.licence, w.step + 1, w.n, (SELECT min(f.pos) FROM found f JOIN steps s ON s.id = f.id WHERE s.rule = w.rule AND s.step = w.step AND f.doc_id = w.doc_id AND f.way = w.way AND f.pos > w.pos)
  FROM walk w WHERE w.step < w.n AND w.pos IS NOT NULL),
named AS (SELECT doc_id, licence FROM found WHERE licence <> ''
  UNION SELECT doc_id, licence FROM walk w WHERE step = n AND pos IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM unless u JOIN found f ON f.id = u.id WHERE u.rule = w.rule AND f.doc_id = w.doc_id AND f.way = w.way)),
names AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM named GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n, string_agg(id, ' ' ORDER BY pos) AS ids FROM found WHERE way = 0 GROUP BY doc_id)
SELECT d.doc_id, coalesce(licences, '') AS licences, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(ids, '') AS sentence_ids
FROM documents d LEFT JOIN names ON names.doc_id = d.doc_id LEFT JOIN ids ON ids.doc_id = d.doc_id
"""


ORACLE = _oracle()
