"""License scans by sentence rules.

A text is normalised (lower case, every run of other characters than letters
and digits one space) and cut at line ends, colons, sentence points and blank
lines. Known license sentences stand from one cut to another; line ends (with
the comment marks of the next line) and colons may lie inside them, so wrapped
and commented texts are found as well as titles on lines of their own. The
longest one at a place becomes an identifier; an SPDX expression becomes one per
license it names. Lines that hold only a URL, copyright lines and item numbers are
left out, so they break no sequence. The identifiers of a text, in order, are matched against license
rules, which are ordered sequences of identifiers. The first rule that matches
at a place wins, and the scan goes on after it. All of it is DataFrame
expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.llm.common import without

# Sentences of public licenses and notices, normalised by
# ``normalise`` when the table is built, with the identifier of each.
SENTENCES = {
    "apache-ref": ["Licensed under the Apache License, Version 2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\")",
                   "This project is licensed under the Apache License 2.0",
                   "SPDX-License-Identifier: Apache-2.0"],
    "apache-comply": ["you may not use this file except in compliance with the License"],
    "apache-copy": ["You may obtain a copy of the License at",
                    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                    "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "apache-basis": ["Unless required by applicable law or agreed to in writing, software "
                     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "mit-ref": ["Released under the MIT License", "Licensed under the MIT License", "MIT License",
                "This project is licensed under the MIT License", "The MIT License (MIT)",
                "SPDX-License-Identifier: MIT"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of "
                  "this software and associated documentation files (the \"Software\"), to deal in "
                  "the Software without restriction",
                  "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                  "this software and associated documentation files (the \"Software\"), to deal in "
                  "the Software without restriction, including without limitation the rights to use, "
                  "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                  "Software, and to permit persons to whom the Software is furnished to do so, subject "
                  "to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all "
                   "copies or substantial portions of the Software"],
    "gpl3-ref": ["This work is licensed under the GNU General Public License, version 3",
                 "Licensed under the GNU General Public License, version 3",
                 "GNU General Public License version 3", "SPDX-License-Identifier: GPL-3.0-only",
                 "SPDX-License-Identifier: GPL-3.0"],
    "gpl3-later-ref": ["SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl2-ref": ["Licensed under the GNU General Public License, version 2",
                 "GNU General Public License version 2", "SPDX-License-Identifier: GPL-2.0-only",
                 "SPDX-License-Identifier: GPL-2.0"],
    "gpl2-later-ref": ["SPDX-License-Identifier: GPL-2.0-or-later"],
    "gpl2-terms": ["you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License version 2 as published by the Free Software Foundation"],
    "gpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation"],
    "lgpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU Lesser "
                   "General Public License as published by the Free Software Foundation"],
    "agpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU Affero "
                   "General Public License as published by the Free Software Foundation"],
    "v2-later": ["either version 2 of the License, or (at your option) any later version"],
    "v2.1-later": ["either version 2.1 of the License, or (at your option) any later version"],
    "v3-later": ["either version 3 of the License, or (at your option) any later version"],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the "
                 "terms of the GNU General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later "
                 "version"],
    "lgpl3-ref": ["Licensed under the GNU Lesser General Public License, version 3",
                  "SPDX-License-Identifier: LGPL-3.0-only"],
    "lgpl3-later-ref": ["SPDX-License-Identifier: LGPL-3.0-or-later"],
    "lgpl-free": ["This program is free software: you can redistribute it and/or modify it under the "
                  "terms of the GNU Lesser General Public License as published by the Free Software "
                  "Foundation, either version 3 of the License, or (at your option) any later "
                  "version"],
    "lgpl21-ref": ["Licensed under the GNU Lesser General Public License, version 2.1",
                   "SPDX-License-Identifier: LGPL-2.1-only"],
    "lgpl21-later-ref": ["SPDX-License-Identifier: LGPL-2.1-or-later"],
    "agpl3-ref": ["Licensed under the GNU Affero General Public License, version 3",
                  "SPDX-License-Identifier: AGPL-3.0-only"],
    "agpl3-later-ref": ["SPDX-License-Identifier: AGPL-3.0-or-later"],
    "agpl-free": ["This program is free software: you can redistribute it and/or modify it under the "
                  "terms of the GNU Affero General Public License as published by the Free Software "
                  "Foundation, either version 3 of the License, or (at your option) any later "
                  "version"],
    "bsd3-ref": ["Licensed under the BSD 3-Clause License", "BSD 3-Clause License",
                 "SPDX-License-Identifier: BSD-3-Clause"],
    "bsd2-ref": ["Licensed under the BSD 2-Clause License", "BSD 2-Clause License",
                 "SPDX-License-Identifier: BSD-2-Clause"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, "
                  "are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list "
                   "of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this "
                   "list of conditions and the following disclaimer in the documentation and/or other "
                   "materials provided with the distribution"],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may "
                    "be used to endorse or promote products derived from this software without "
                    "specific prior written permission"],
    "isc-ref": ["Licensed under the ISC License", "ISC License", "SPDX-License-Identifier: ISC"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose "
                  "with or without fee is hereby granted, provided that the above copyright notice "
                  "and this permission notice appear in all copies",
                  "Permission to use, copy, modify, and distribute this software for any purpose "
                  "with or without fee is hereby granted, provided that the above copyright notice "
                  "and this permission notice appear in all copies"],
    "bsl-ref": ["Distributed under the Boost Software License, Version 1.0",
                "Boost Software License - Version 1.0", "SPDX-License-Identifier: BSL-1.0"],
    "epl2-ref": ["Licensed under the Eclipse Public License, version 2.0",
                 "SPDX-License-Identifier: EPL-2.0"],
    "mpl2-terms": ["This Source Code Form is subject to the terms of the Mozilla Public License, v"],
    "mpl2-ref": ["Licensed under the Mozilla Public License, version 2.0",
                 "SPDX-License-Identifier: MPL-2.0"],
    "cc-by-nc-ref": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0",
                     "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa-ref": ["Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0",
                     "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc-by-ref": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0",
                  "SPDX-License-Identifier: CC-BY-4.0"],
    "cc0-ref": ["Licensed under CC0 1.0", "This work is dedicated to the public domain",
                "SPDX-License-Identifier: CC0-1.0"],
    "unlicense-ref": ["This is free and unencumbered software released into the public domain"],
    "reserved": ["All rights reserved"],
}


@dataclass(frozen=True)
class LicenseRule:
    """An ordered sequence of sentence identifiers and what it says."""

    license: str
    sentences: tuple[str, ...]
    category: str


# Longer sequences stand before their own beginnings.
RULES = [
    LicenseRule("Apache-2.0", ("apache-ref", "apache-comply", "apache-copy", "apache-basis"), "permissive"),
    LicenseRule("Apache-2.0", ("apache-ref",), "permissive"),
    LicenseRule("MIT", ("mit-ref", "mit-grant", "mit-notice"), "permissive"),
    LicenseRule("MIT", ("mit-grant", "mit-notice"), "permissive"),
    LicenseRule("MIT", ("mit-ref",), "permissive"),
    LicenseRule("GPL-3.0", ("gpl3-ref", "gpl-free"), "copyleft"),
    LicenseRule("GPL-3.0", ("gpl3-ref",), "copyleft"),
    LicenseRule("GPL-3.0-or-later", ("gpl-free",), "copyleft"),
    LicenseRule("GPL-3.0-or-later", ("gpl-terms", "v3-later"), "copyleft"),
    LicenseRule("GPL-3.0-or-later", ("gpl3-later-ref",), "copyleft"),
    LicenseRule("GPL-2.0-or-later", ("gpl-terms", "v2-later"), "copyleft"),
    LicenseRule("GPL-2.0-or-later", ("gpl2-later-ref",), "copyleft"),
    LicenseRule("GPL-2.0", ("gpl2-terms",), "copyleft"),
    LicenseRule("GPL-2.0", ("gpl2-ref",), "copyleft"),
    LicenseRule("AGPL-3.0", ("agpl3-ref", "agpl-free"), "network-copyleft"),
    LicenseRule("AGPL-3.0", ("agpl3-ref",), "network-copyleft"),
    LicenseRule("AGPL-3.0-or-later", ("agpl-free",), "network-copyleft"),
    LicenseRule("AGPL-3.0-or-later", ("agpl-terms", "v3-later"), "network-copyleft"),
    LicenseRule("AGPL-3.0-or-later", ("agpl3-later-ref",), "network-copyleft"),
    LicenseRule("LGPL-3.0", ("lgpl3-ref",), "weak-copyleft"),
    LicenseRule("LGPL-3.0-or-later", ("lgpl-free",), "weak-copyleft"),
    LicenseRule("LGPL-3.0-or-later", ("lgpl-terms", "v3-later"), "weak-copyleft"),
    LicenseRule("LGPL-3.0-or-later", ("lgpl3-later-ref",), "weak-copyleft"),
    LicenseRule("LGPL-2.1-or-later", ("lgpl-terms", "v2.1-later"), "weak-copyleft"),
    LicenseRule("LGPL-2.1-or-later", ("lgpl21-later-ref",), "weak-copyleft"),
    LicenseRule("LGPL-2.1", ("lgpl21-ref",), "weak-copyleft"),
    LicenseRule("MPL-2.0", ("mpl2-ref",), "weak-copyleft"),
    LicenseRule("MPL-2.0", ("mpl2-terms",), "weak-copyleft"),
    LicenseRule("EPL-2.0", ("epl2-ref",), "weak-copyleft"),
    LicenseRule("ISC", ("isc-ref", "isc-grant"), "permissive"),
    LicenseRule("ISC", ("isc-grant",), "permissive"),
    LicenseRule("ISC", ("isc-ref",), "permissive"),
    LicenseRule("BSL-1.0", ("bsl-ref",), "permissive"),
    # A title, the rights line and the clauses, as many as there are.
    *[LicenseRule(name, (*head, *rights, "bsd-grant", *clauses), "permissive")
      for clauses, plain in ((("bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
                             (("bsd-source", "bsd-binary"), "BSD-2-Clause"), ((), "BSD"))
      for head, name in ((("bsd3-ref",), "BSD-3-Clause"), (("bsd2-ref",), "BSD-2-Clause"), ((), plain))
      for rights in (("reserved",), ())],
    LicenseRule("BSD-3-Clause", ("bsd3-ref",), "permissive"),
    LicenseRule("BSD-2-Clause", ("bsd2-ref",), "permissive"),
    LicenseRule("CC-BY-NC-4.0", ("cc-by-nc-ref",), "non-commercial"),
    LicenseRule("CC-BY-SA-4.0", ("cc-by-sa-ref",), "share-alike"),
    LicenseRule("CC-BY-4.0", ("cc-by-ref",), "permissive"),
    LicenseRule("CC0-1.0", ("cc0-ref",), "public-domain"),
    LicenseRule("Unlicense", ("unlicense-ref",), "public-domain"),
    LicenseRule("Proprietary", ("reserved",), "restricted"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# What ``cut_text`` does to a lower-case text, in order. Between
# words it leaves a space, a newline (line end or colon: a sentence may end here
# or go on) or a P (point or blank line: every sentence ends here).
CUTS = [
    ("\r\n?", "\n"),
    (r"([0-9])\+", "$1 or later"),                                       # SPDX: GPL-2.0+
    (r"(?md)^[^a-z0-9\n]*+(?:https?|ftp)://\S++[^a-z0-9\n]*+$", ""),     # lines of a URL only
    (r"(\A|\n)[^a-z0-9\n]*+(?:(?:dnl|rem)[ \t]++)?", "$1"),            # comment marks
    (r"[.;!?](?=[ \t\n])", "P"),
    (r":(?=[ \t]++[^\n])", "\n"),
    (r"[^a-z0-9\nP]+", " "),
    (" ?\n ?", "\n"),
    ("\n{2,}", "P"),
    ("[\n ]?P[\nP ]*", "P"),
    (r"\A | \z", ""),
]


#: Sentences (as ``cut_text`` leaves them) that break no sequence: copyright
#: lines and item numbers.
NEUTRAL = r"^(?:(?:portions )?copyright (?:c |[0-9]{4})|c [0-9]{4} |[0-9]{1,2}$)"
SPDX = "spdx license identifier "


def normalise(sentence: str) -> str:
    """A known sentence as ``cut_text`` leaves it on one line, for the tables."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(kept.split())


def cut_text(text: Column) -> Column:
    """The normalised text, with its cuts."""
    out = F.translate(text, UPPER, LOWER)
    for pattern, to in CUTS:
        out = F.regexp_replace(out, pattern, to)
    return out


def sentence_ids(text: Column, sentences: dict[str, list[str]]) -> Column:
    """Identifiers of the known sentences of a text, in order; an unknown
    sentence between two known ones breaks the sequence (an empty entry). An SPDX
    line names licenses joined by ``or`` and ``and``; exceptions (``with``) are
    passed over."""
    known = {normalise(s): i for i, group in sentences.items() for s in group}
    table = F.create_map(*[F.lit(x) for kv in sorted(known.items()) for x in kv])
    # At each cut the longest known sentence that ends at a cut, or else all up
    # to the next cut.
    longest = sorted(known, key=lambda s: (-len(s), s))
    whole = "|".join(s.replace(" ", r"[ \n]") for s in longest)
    parts = F.regexp_extract_all(cut_text(text), F.lit(
        rf"(?<![^\nP])(?:(?:{whole})(?![^\nP])|{SPDX[:-1].replace(' ', '[ \n]')}[ \n][^\nP]+|[^\nP]+)"),
        F.lit(0))
    full = F.filter(F.transform(parts, lambda s: F.trim(F.translate(s, "\n", " "))),
                    lambda s: (s != "") & ~s.rlike(NEUTRAL))

    def known_id(s: Column) -> Column:
        return F.coalesce(F.try_element_at(table, s), F.lit(""))

    def terms(s: Column) -> Column:
        joined = F.replace(F.substr(s, F.lit(len(SPDX) + 1)), F.lit(" or later"), F.lit(" orlater"))
        return F.transform(F.split(joined, " (?:or|and) "), lambda x: F.concat(
            F.lit(SPDX), F.replace(F.regexp_replace(x, " with .*", ""), F.lit(" orlater"), F.lit(" or later"))))

    named = F.transform(full, lambda s: F.when(s.startswith(SPDX) & (known_id(s) == ""), terms(s))
                        .otherwise(F.array(s)))
    return F.transform(F.flatten(named), known_id)


# Fixed value: rarer words of the known sentences, normalised.
CLUES = ["license", "licence", "spdx", "permission", "copyright", "redistribution", "public domain",
         "rights reserved", "gnu general"]
#: What may stand between two words of a sentence, comment marks included.
GAP = r"[^a-z0-9]+(?:(?:dnl|rem)[^a-z0-9]+)?"


def _clue(sentences: dict[str, list[str]]) -> str:
    """A pattern that every known sentence matches, however ``cut_text`` came to
    it: a few of its rarer words."""
    known = [normalise(s) for group in sentences.values() for s in group]
    clues = CLUES + [s for s in known if not any(c in s for c in CLUES)]
    return "(?i)" + "|".join(GAP.join(c.split()) for c in clues)


def scan_licenses(docs: DataFrame, *, text: str = "text",
                  sentences: dict[str, list[str]] | None = None,
                  rules: list[LicenseRule] | None = None) -> DataFrame:
    """``docs`` plus ``sentence_ids`` (known sentences in order), ``licenses``
    (one entry per rule match, in order of place) and ``categories`` (distinct,
    sorted).

    Null and empty texts have none. Rows are scanned one by one, so ties and
    repeated rows change nothing. Map-only: no shuffle, no Python."""
    sentences = SENTENCES if sentences is None else sentences
    rules = RULES if rules is None else rules
    none = F.array().cast("array<string>")
    t = F.col(f"`{text}`")
    base = without(docs, *{"sentence_ids", "licenses", "categories"} - {text})
    ids = F.when(t.rlike(_clue(sentences)), sentence_ids(t, sentences)).otherwise(none)
    # The sequence as text, one token per sentence; a rule is a token sequence,
    # and alternation tries the rules in order at every place.
    out = base.withColumn("__all", F.coalesce(ids, none))
    out = out.withColumn("sentence_ids", F.filter("__all", lambda s: s != ""))
    line = F.concat(F.array_join(F.transform("__all", lambda s: F.concat(F.lit("<"), s, F.lit(">"))), ""))
    distinct = list(dict.fromkeys("".join(f"<{i}>" for i in r.sentences) for r in rules))
    matches = F.regexp_extract_all(line, F.lit("(" + "|".join(distinct) + ")"), F.lit(0))
    first = {}
    for r in rules:
        first.setdefault("".join(f"<{i}>" for i in r.sentences), r)
    name = F.create_map(*[F.lit(x) for k, r in first.items() for x in (k, r.license)])
    kind = F.create_map(*[F.lit(x) for k, r in first.items() for x in (k, r.category)])
    out = out.withColumn("__found", F.when(F.size("sentence_ids") > 0, matches).otherwise(none))
    return (out.withColumn("licenses", F.transform("__found", lambda m: F.element_at(name, m)))
            .withColumn("categories", F.array_sort(F.array_distinct(
                F.transform("__found", lambda m: F.element_at(kind, m)))))
            .drop("__all", "__found"))
