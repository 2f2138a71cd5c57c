"""Licence recognition by sentences and ordered rules; one pass over each row, no shuffle.

A text is cut into sentences, each normalised sentence is mapped to the identifier of a
known licence sentence, and the sequence of identifiers is matched with ordered rules:
a rule is a run of identifiers, longer rules come first and use up what they match.
A known sentence that the cut divides has an identifier for each part, and a rule asks
for all of them in order.
DataFrame operations only.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _notice(terms: str, version: str, *things: str) -> list[str]:
    """The Free Software Foundation's "or later" notice in both punctuations."""
    return [f"This {thing} is free software: you can redistribute it and/or modify it under "
            f"the terms of the GNU {terms} as published by the Free Software Foundation{mark} "
            f"either version {version} of the License, or (at your option) any later version."
            for thing in things or ("program",) for mark in (",", ";")]


# Known sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit-name": ["Released under the MIT License.", "Licensed under the MIT License.",
                 "The MIT License (MIT)", "MIT License",
                 "This project is licensed under the MIT License."],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a "
                  "copy of this software and associated documentation files (the "
                  "\"Software\"), to deal in the Software without restriction, including "
                  "without limitation the rights to use, copy, modify, merge, publish, "
                  "distribute, sublicense, and/or sell copies of the Software, and to permit "
                  "persons to whom the Software is furnished to do so, subject to the "
                  "following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included "
                   "in all copies or substantial portions of the Software."],
    "apache2-name": ["Licensed under the Apache License, Version 2.0.",
                     "Apache License, Version 2.0",
                     "Licensed under the Apache License, Version 2.0 (the \"License\");"],
    "apache2-use": ["you may not use this file except in compliance with the License."],
    "apache2-copy": ["You may obtain a copy of the License at"],
    "apache2-asis": ["Unless required by applicable law or agreed to in writing, software "
                     "distributed under the License is distributed on an \"AS IS\" BASIS, "
                     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                     "implied."],
    "gpl3-name": ["This work is licensed under the GNU General Public License, version 3.",
                  "Licensed under the GNU General Public License, version 3.",
                  "GNU General Public License, version 3"],
    "gpl2-name": ["This work is licensed under the GNU General Public License, version 2.",
                  "Licensed under the GNU General Public License, version 2."],
    "gpl-free": _notice("General Public License", "3"),
    "gpl2-free": _notice("General Public License", "2"),
    "gpl2-only-free": ["This program is free software; you can redistribute it and/or modify "
                       "it under the terms of the GNU General Public License version 2 as "
                       "published by the Free Software Foundation."],
    "agpl3-free": _notice("Affero General Public License", "3"),
    "lgpl3-free": _notice("Lesser General Public License", "3", "program", "library"),
    "lgpl21-free": _notice("Lesser General Public License", "2.1", "program", "library"),
    "lgpl2-free": _notice("Library General Public License", "2", "program", "library"),
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but "
                     "WITHOUT ANY WARRANTY; without even the implied warranty of "
                     "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without "
                  "modification, are permitted provided that the following conditions are "
                  "met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, "
                   "this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright "
                   "notice, this list of conditions and the following disclaimer in the "
                   "documentation and/or other materials provided with the distribution."],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its "
                  "contributors may be used to endorse or promote products derived from this "
                  "software without specific prior written permission."],
    "ccbync4-name": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under CC BY-NC 4.0."],
    "ccby4-name": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
    "ccbysa4-name": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under CC BY-SA 4.0."],
}

# Rules in order; (licence, run of sentences).
_RULES = [
    ("Apache-2.0", ["apache2-name", "apache2-use", "apache2-copy", "apache2-asis"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-name", "mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("GPL-2.0-only", ["gpl2-only-free"]),
    ("AGPL-3.0-or-later", ["agpl3-free"]),
    ("LGPL-3.0-or-later", ["lgpl3-free"]),
    ("LGPL-2.1-or-later", ["lgpl21-free"]),
    ("LGPL-2.0-or-later", ["lgpl2-free"]),
    ("GPL-3.0-only", ["gpl3-name"]),
    ("GPL-2.0-only", ["gpl2-name"]),
    ("Apache-2.0", ["apache2-name"]),
    ("MIT", ["mit-name"]),
    ("CC-BY-NC-4.0", ["ccbync4-name"]),
    ("CC-BY-SA-4.0", ["ccbysa4-name"]),
    ("CC-BY-4.0", ["ccby4-name"]),
]

#: A line or a full stop ends a sentence; or, for wrapped texts, a blank line does.
BY_LINE = r"[.!?;:]+[\x20\x09]+|[\x0A-\x0D]+"
BY_PARAGRAPH = r"[.!?;:]+[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*"


def normalise(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def parts(sentence: str, cut: str = BY_PARAGRAPH) -> list[str]:
    """What the cut makes of a sentence, normalised."""
    return [p for p in map(normalise, re.split(cut, sentence)) if p]


def sentence_map(sentences=SENTENCES, cut: str = BY_PARAGRAPH) -> dict[str, str]:
    """Normalised part -> identifier: the sentence's name if the cut leaves it whole, or
    name/number; a part that several sentences share keeps its first identifier."""
    out: dict[str, str] = {}
    for name, texts in sentences.items():
        n = 0
        for t in texts:
            own = parts(t, cut)
            for p in own:
                if p not in out:
                    n += len(own) > 1
                    out[p] = f"{name}/{n}" if len(own) > 1 else name
    return out


def expanded(rules, sentences=SENTENCES, cut: str = BY_PARAGRAPH) -> list:
    """Rules over the parts' identifiers, one for every wording of the rule's sentences."""
    known, out = sentence_map(sentences, cut), []
    for licence, run in rules:
        ways = [list(dict.fromkeys(tuple(known[p] for p in parts(t, cut))
                                   for t in sentences.get(x, ()) if parts(t, cut))) or [(x,)]
                for x in run]
        out += [(licence, [x for way in choice for x in way]) for choice in product(*ways)]
    return out


def anchors(sentences=SENTENCES, cut: str = BY_PARAGRAPH) -> tuple[str, ...]:
    """A few words of which every known part holds one, so a text without them has none."""
    left, out = set(sentence_map(sentences, cut)), []
    while left:
        words = {w for p in left for w in p.split()}
        best = min(words, key=lambda w: (len(w) < 6, -sum(w in p for p in left), -len(w), w))
        out.append(best)
        left = {p for p in left if best not in p}
    return tuple(out)


RULES = expanded(_RULES)
ANCHORS = anchors()


def identifiers(text: Column, cut: str, known: dict[str, str]) -> Column:
    """The known sentences' identifiers in order, each in angle brackets, as one string."""
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    clean = F.transform(F.split(F.lower(text), cut), lambda s: F.trim(
        F.regexp_replace(s, "[^a-z0-9]+", " ")))
    hits = F.filter(clean, lambda s: s.isin(list(known)))
    return F.array_join(F.transform(hits, lambda s: F.concat(
        F.lit("<"), F.element_at(table, s), F.lit(">"))), "")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sentences=SENTENCES, rules=RULES) -> DataFrame:
    """Per row: ``id_col``, sentence_ids, licenses (comma-separated, sorted), n_licenses.

    ``rules`` name sentences, or parts as ``sentence_map`` does.

    Both cuts are read: by line, and by paragraph for wrapped texts; a licence counts if
    either finds it; sentence_ids are those of the cut by line, or, where that has none,
    by paragraph.  Null, empty and unlicensed texts give empty strings and 0; repeated
    rows are repeated; an empty table gives no rows.
    """
    known, rules = sentence_map(sentences), expanded(rules, sentences)
    text = F.coalesce(F.col(text_col), F.lit(""))
    maybe = F.lower(text).rlike("|".join(anchors(sentences)))
    df = docs.select(
        F.col(id_col),
        F.when(maybe, identifiers(text, BY_LINE, known)).otherwise("").alias("by_line"),
        F.when(maybe, identifiers(text, BY_PARAGRAPH, known)).otherwise("").alias("by_par"))
    found = []
    rest = {k: F.col(seq) for k, seq in enumerate(("by_line", "by_par"))}
    for j, (licence, run) in enumerate(rules):
        pattern = F.lit("".join(f"<{x}>" for x in run))
        df = df.withColumns(
            {f"hit_{k}_{j}": F.contains(r, pattern) for k, r in rest.items()}
            | {f"rest_{k}": F.replace(r, pattern, F.lit("|")) for k, r in rest.items()})
        rest = {k: F.col(f"rest_{k}") for k in rest}
        found += [F.when(F.col(f"hit_{k}_{j}"), F.lit(licence)) for k in rest]
    names = F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))
    return df.select(
        F.col(id_col),
        F.when(F.col("by_line") != "", F.col("by_line")).otherwise(F.col("by_par"))
        .alias("sentence_ids"),
        F.array_join(names, ",").alias("licenses"),
        F.size(names).cast("int").alias("n_licenses"))
