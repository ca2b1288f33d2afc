"""License scan by sentence rules.

Texts are cut into sentences, which end at punctuation, a blank line (also one
of comment marks only) or the text's end; each is normalised (lower case, runs
of other characters than letters and digits become a space). Candidates are
whole lines of a sentence, one or more in a row, so a licence may be wrapped
over lines, in a comment or not, and a notice on a line of its own is found
without punctuation around it. A line opens candidates only if its first words
are those of a known sentence; each candidate is looked up by hash among the
known ones, the longest at a line counts, and one that begins inside another is
no match. So the work of a text does not depend on how many sentences are
known. The identifiers found, in order, are matched against licence rules:
sequences of identifiers, the first rule that fits at a place taking its
identifiers. All steps are expressions on a row; nothing is shuffled, so no
text, however frequent, meets another.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import ascii_lower

# Sentences of well-known licences and notices, as identifier and text.
_SENTENCES = [
    ("mit-released", "Released under the MIT License"),
    ("mit-licensed", "Licensed under the MIT License"),
    ("mit-licensed", "This project is licensed under the MIT License"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("warranty-mit", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("liability-mit", "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"),
    ("warranty-isc", "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("liability-isc", "In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software"),
    ("warranty-bsd", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd-advertising", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("zlib-grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("zlib-warranty", "This software is provided 'as-is', without any express or implied warranty"),
    ("zlib-origin", "The origin of this software must not be misrepresented"),
    ("zlib-altered", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("zlib-notice", "This notice may not be removed or altered from any source distribution"),
    ("boost-grant", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"),
    ("boost-notice", "Distributed under the Boost Software License, Version 1.0"),
    ("apache-condition", "You may not use this file except in compliance with the License"),
    ("apache-copy", "You may obtain a copy of the License at"),
    ("apache-as-is", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("apache-governing", "See the License for the specific language governing permissions and limitations under the License"),
    # its sentences end at "v." and at the colon of the address
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v"),
    ("mpl-2.0-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at http"),
    ("mpl-2.0-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at https"),
    ("epl-accompanying", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("epl-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("gpl-free", "This program is free software"),
    ("gpl-library", "This library is free software"),
    ("gpl-hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("gpl-received", "You should have received a copy of the GNU General Public License along with this program"),
    ("lgpl-received", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("spdx", "SPDX-License-Identifier"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights", "All rights reserved"),
]
_CC = ["CC BY", "CC BY-SA", "CC BY-NC", "CC BY-ND", "CC BY-NC-SA", "CC BY-NC-ND"]
_CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
_GNU = [("gpl", "GNU General Public License", ["1", "2", "3"]),
        ("lgpl", "GNU Lesser General Public License", ["2.1", "3"]),
        ("agpl", "GNU Affero General Public License", ["3"])]


def _normal(text: str) -> str:
    return re.sub("[^0-9a-z]+", " ", text.lower()).strip()


# Names after an SPDX marker, and the terms of the GNU licences in prose: "<either> version N of the License".
_SPDX = ["MIT", "ISC", "Zlib", "Unlicense", "BSL-1.0", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "EPL-1.0",
         "EPL-2.0", "CC0-1.0", "0BSD"]
_TERMS = "you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version"
_ONLY = "you can redistribute it and/or modify it under the terms of the {name} version {v} as published by the Free Software Foundation"


def spdx_names() -> list[str]:
    gnu = [f"{s.upper()}-{v}" + ("" if "." in v else ".0") + end for s, _, vs in _GNU for v in vs for end in ("-only", "-or-later")]
    return _SPDX + gnu


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    out = [(i, t) for i, t in _SENTENCES]
    for version in ("1.1", "2.0"):
        out.append((f"apache-{version}", f"Licensed under the Apache License, Version {version}"))
        out.append((f"apache-{version}", f"Licensed under the Apache License, Version {version} (the \"License\")"))
    for name in _CC:
        for version in _CC_VERSIONS:
            own = f"{name} {version}".lower().replace(" ", "-")
            out += [(own, f"Licensed under {name} {version}"), (own, f"This work is licensed under {name} {version}")]
    for short, name, versions in _GNU:
        for v in versions:
            out += [(f"{short}-{v}", f"This work is licensed under the {name}, version {v}"),
                    (f"{short}-{v}", f"Licensed under the {name}, version {v}"),
                    (f"{short}-{v}-terms", _TERMS.format(name=name, v=v)), (f"{short}-{v}-only", _ONLY.format(name=name, v=v))]
    out += [(f"name-{n.lower()}", n) for n in spdx_names()]
    return {_normal(t): i for i, t in out}


def rules() -> list[tuple[str, list[str]]]:
    """(licence, identifiers in order); earlier rules hold before later ones.
    An SPDX name counts after its marker only, a disclaimer by itself names no
    licence."""
    out = [(n, ["spdx", f"name-{n.lower()}"]) for n in spdx_names()]
    out += [("BSD-4-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advertising"]),
            ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
            ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
            ("MIT", ["mit-grant", "mit-notice", "warranty-mit", "liability-mit"]), ("MIT", ["mit-grant", "mit-notice", "warranty-mit"]),
            ("MIT", ["mit-grant", "mit-notice"]), ("MIT", ["mit-grant"]),
            ("MIT", ["mit-released"]), ("MIT", ["mit-licensed"]),
            ("ISC", ["isc-grant", "warranty-isc", "liability-isc"]), ("ISC", ["isc-grant"]),
            ("Zlib", ["zlib-warranty", "zlib-grant", "zlib-origin", "zlib-altered", "zlib-notice"]), ("Zlib", ["zlib-grant"]),
            ("BSL-1.0", ["boost-grant"]), ("BSL-1.0", ["boost-notice"]), ("MPL-2.0", ["mpl-2.0", "mpl-2.0-copy"]), ("MPL-2.0", ["mpl-2.0"]),
            ("EPL-2.0", ["epl-2.0"]), ("EPL-1.0", ["epl-1.0"]), ("EPL", ["epl-accompanying"]), ("WTFPL", ["wtfpl"]), ("CC0-1.0", ["cc0"]),
            ("Unlicense", ["unlicense"])]
    for v in ("1.1", "2.0"):
        out += [(f"Apache-{v}", [f"apache-{v}", "apache-condition", "apache-copy", "apache-as-is", "apache-governing"]),
                (f"Apache-{v}", [f"apache-{v}"])]
    out += [(f"{n} {v}".replace(" ", "-"), [f"{n} {v}".lower().replace(" ", "-")]) for n in _CC for v in _CC_VERSIONS]
    for s, _, vs in _GNU:
        for v in vs:
            name, free = f"{s.upper()}-{v}" + ("" if "." in v else ".0"), "gpl-library" if s == "lgpl" else "gpl-free"
            out += [(f"{name}-or-later", [free, f"{s}-{v}-terms"]), (f"{name}-only", [free, f"{s}-{v}-only"]), (name, [f"{s}-{v}"]),
                    (f"{name}-or-later", [f"{s}-{v}-terms"]), (f"{name}-only", [f"{s}-{v}-only"])]
    out += [("GPL", ["gpl-free"]), ("LGPL", ["gpl-library"]), ("GPL", ["gpl-received"]), ("LGPL", ["lgpl-received"]), ("Proprietary", ["all-rights"])]
    return out


def _literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def rule_pattern() -> str:
    """Matches the first rule, in order, at each place of the joined identifiers."""
    return "|".join("".join(re.escape(i) + ";" for i in ids) for _, ids in rules())


def openers() -> list[str]:
    """The first two words (or the only one) of the known sentences."""
    return sorted({" ".join(t.split(" ")[:2]) for t in known_sentences()})


def longest() -> int:
    """Words of the longest known sentence: no candidate has more lines."""
    return max(t.count(" ") + 1 for t in known_sentences())


# Steps of ``lines``: pattern, replacement. A newline is left where a sentence goes on in the next line, a P (no
# capital is left by then) where one ends. Comment marks such as ; and ! at the start of a line end no sentence.
STEPS = [(r"(^|\n)[^0-9a-z\n.:?]+", r"\1"), (r"[.!?;:]([^0-9a-z])", r"P\1"), (r"[^0-9a-zP\n]+", " "),
         (r"[ \n]*P[ \nP]*| *\n *\n[ \nP]*", "P"), (r" *\n *", "\n")]


def lines(text: Column) -> Column:
    """Normalised text, its sentences apart by P and their lines by newlines."""
    t = ascii_lower(F.coalesce(text, F.lit("")))
    for pattern, to in STEPS:
        # a repeat never gives back what it took
        pattern = pattern.replace("]+", "]++").replace("]*", "]*+").replace(" *", " *+")
        t = F.regexp_replace(t, pattern, to.replace("\\1", "$1"))
    return F.btrim(t, F.lit(" \nP"))


def _opened(own: Column) -> Column:
    """For every line of a sentence the longest known run of lines from it on
    (struct of its number of lines and its text), or null."""
    most, known, first = longest(), list(known_sentences()), openers()

    def at_line(line: Column, i: Column) -> Column:
        head = F.substring_index(F.concat_ws(" ", line, F.get(own, i + 1)), " ", 2)
        runs = F.transform(F.sequence(F.lit(1), F.least(F.size(own) - i, F.lit(most))), lambda n: F.struct(
            n.alias("n"), F.array_join(F.slice(own, i + 1, n), " ").alias("text")))
        hit = F.filter(runs, lambda r: r["text"].isin(known))
        return F.when(head.isin(first) | line.isin(first), F.try_element_at(hit, F.lit(-1)))

    return F.transform(own, at_line)


def _kept(opened: Column) -> Column:
    """The matches that do not begin inside another: no line before has a
    match of more lines than lie between."""
    def covered(i: Column) -> Column:
        return F.exists(F.sequence(F.lit(1), F.least(i, F.lit(longest()))), lambda k: F.coalesce(F.get(opened, i - k)["n"] > k, F.lit(False)))

    return F.array_compact(F.transform(opened, lambda m, i: F.when(
        m.isNotNull() & F.when(i > 0, ~covered(i)).otherwise(F.lit(True)), m["text"])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_sentences (pieces between punctuation and line ends),
    sentence_ids (joined by ``;``), licenses (sorted, joined by ``,``),
    n_matches. Null counts as empty; a text without a known sentence has empty
    strings and 0 matches."""
    table, names = _literal_map(known_sentences()), _literal_map({"".join(i + ";" for i in ids): n for n, ids in rules()})
    d = docs.select(F.col(id_col).alias("doc_id"), lines(F.col(text_col)).alias("t"))
    n = F.when(F.col("t") == "", 0).otherwise(F.length("t") - F.length(F.translate("t", "\nP", "")) + 1)
    # one step after the other, so that each array is made once
    own = F.transform(F.split("t", "P", -1), lambda x: F.split(x, "\n", -1))
    found = F.flatten(F.transform(F.transform(own, _opened), _kept))
    d = d.select("doc_id", n.cast("long").alias("n_sentences"), F.transform(found, lambda s: F.try_element_at(table, s)).alias("ids"))
    d = d.withColumn("sentence_ids", F.array_join(F.transform("ids", lambda i: F.concat(i, F.lit(";"))), ""))
    d = d.withColumn("m", F.regexp_extract_all("sentence_ids", F.lit(rule_pattern()), F.lit(0)))
    found = F.array_sort(F.array_distinct(F.transform("m", lambda x: F.try_element_at(names, x))))
    return d.select("doc_id", "n_sentences", "sentence_ids", F.array_join(found, ",").alias("licenses"),
                    F.size("m").cast("long").alias("n_matches"))
