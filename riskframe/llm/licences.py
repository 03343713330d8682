"""Licence texts found by canonical digests.

A text is brought to a canonical form: A-Z lower-cased, copyright statements dropped, punctuation and
spacing reduced to single blanks, equivalent spellings made one. Entire texts, and each of their
lines, are looked up by the digest of that form among known licences and notices: the texts below, and
a table of digests of the common ones (`forms`, `notices`).

The form is worked out inside the row. Only the known digests are broadcast, a list fixed by the
caller; a text never meets more than the one licence of its digest.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.text import filled, lines_of, lower_ascii

ALPHANUMERIC = "abcdefghijklmnopqrstuvwxyz0123456789"

# --- fixed values: words that follow "copyright" or "(c)" inside sentences ------
# A line that a wrap lets begin so is text of the licence and not a copyright statement.
SENTENCE_WORDS = """a above all also an and any are as at but claim claims disclaimer disclaimers
doctrines each for from has have holder holders if in including infringement interest interests is it
law laws licence licences license licenses like line lines management material may must no nor not
notice notices of on or other owned owner owners ownership patent permission permissions protected
protection related representations resulting right rights shall similar statement statements status
terms that the these this those to treaties treaty under which will with work works you""".split()


def other_word(words: list[str]) -> str:
    """An expression for one word of a-z and 0-9 that is none of `words`, without look-ahead."""
    def after(tails: set[str]) -> str:
        heads = sorted({t[0] for t in tails if t})
        ways = [f"{c}{after({t[1:] for t in tails if t[:1] == c})}" for c in heads]
        ways.append("[" + "".join(c for c in ALPHANUMERIC if c not in heads) + "]")
        return f"(?:{'|'.join(ways if '' in tails else [*ways, '[^a-z0-9]', '$'])})"
    heads = sorted({w[0] for w in words})
    ways = [f"{c}{after({w[1:] for w in words if w[0] == c})}" for c in heads]
    return f"(?:{'|'.join(ways)}|[{''.join(c for c in ALPHANUMERIC if c not in heads)}])"


# The sign, or the word or (c) before (c), the sign, a place to fill in, a year or a holder.
COPYRIGHT_LINE = (
    r"^[^a-z0-9]*(?:©|(?:copyright|\(c\))[^a-z0-9]*(?:\(c\)|©|[0-9]|[\[<{])"
    r"|\(c\)[^a-z0-9]*copyright"
    r"|(?:copyright|\(c\))[^a-z0-9]+(?:the [^\n]*(?:authors|contributors|developers)|"
    + other_word(SENTENCE_WORDS) + "))")

# --- fixed values: spellings of one word; both are written as the second ------
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze",
    "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "catalogue": "catalog", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "licence": "license", "licences": "licenses",
    "licenced": "licensed", "maximise": "maximize", "modelled": "modeled",
    "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while",
    "wilful": "willful",
}

# --- fixed values: licences and notices ---------------------------------------
LICENCES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}

# --- fixed values: title lines and ends that copies of a licence have or leave out ---
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT Licence"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "0BSD"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng license"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", "New BSD License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "Apache-2.0": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
                   "Apache License Version 2.0, January 2004 https://www.apache.org/licenses/"],
    "GPL-1.0": ["GNU GENERAL PUBLIC LICENSE Version 1, February 1989"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.0": ["GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MPL-1.1": ["MOZILLA PUBLIC LICENSE Version 1.1"], "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "CC0-1.0": ["Creative Commons Legal Code CC0 1.0 Universal", "CC0 1.0 Universal"],
    "GFDL-1.2": ["GNU Free Documentation License Version 1.2, November 2002"],
    "GFDL-1.3": ["GNU Free Documentation License Version 1.3, 3 November 2008"],
    "Artistic-1.0": ['The "Artistic License"'],
}
ENDS = ["END OF TERMS AND CONDITIONS", "Exhibit A - Source Code Form License Notice",
        "ADDENDUM: How to use this License for your documents"]

# --- fixed values: what notices call a licence, and how they begin -----------------
NOTICES = {
    "MIT": ["MIT", "MIT License"], "ISC": ["ISC", "ISC License"], "0BSD": ["0BSD"], "Zlib": ["Zlib", "zlib License"],
    "BSD-2-Clause": ["BSD-2-Clause", "BSD 2-Clause License"], "BSD-3-Clause": ["BSD-3-Clause", "BSD 3-Clause License"],
    "Unlicense": ["Unlicense"], "BSL-1.0": ["BSL-1.0", "Boost Software License, Version 1.0"],
    "Apache-2.0": ["Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    **{f"{short}-{v}.0".replace("2.1.0", "2.1"): [
        x for name in (f"GNU {long}General Public License", f"GNU {short}", short)
        for x in (f"{name}, version {v}", f"{name} v{v}", f"{name}-{v}.0".replace("2.1.0", "2.1"))]
       for short, long in (("GPL", ""), ("LGPL", "Lesser "), ("AGPL", "Affero "))
       for v in (("2", "3") if short == "GPL" else ("2.1", "3") if short == "LGPL" else ("3",))},
    "MPL-2.0": ["MPL-2.0", "MPL 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0"],
    **{f"CC-{kind}-{v}": [f"CC {kind} {v}", f"CC {kind} {v} License", f"Creative Commons {words} {v}",
                          f"Creative Commons {words} {v} License", f"Creative Commons {words} {v} International License"]
       for kind, words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                           ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                           ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
       for v in ("2.0", "2.5", "3.0", "4.0")},
}
OPENINGS = [f"{verb} under {the}" for verb in (
    "Licensed", "Released", "Distributed", "This work is licensed", "This project is licensed",
    "This software is licensed") for the in ("", "the ")] + ["SPDX-License-Identifier: "]

DIGESTS = Path(__file__).with_name("licence_digests.csv")


def forms(name: str, text: str) -> list[str]:
    """The text as copies have it: with each title line and without, to its usual end or to the
    end of its terms, with and without 'All rights reserved.' where the title stands."""
    words = " ".join(text.split())
    bodies = [text]
    for title in TITLES.get(name, []):
        start = r"\W*" + r"\W+".join(map(re.escape, re.findall(r"\w+", title))) + r"\W*"
        bodies += [text[m.end():] for m in [re.match(start, text, re.I)] if m]
    bodies += [body[:body.index(end) + len(end) * keep] for body in bodies for end in ENDS if end in body
               for keep in ((0, 1) if end == ENDS[0] else (0,))]
    bodies += [f"All rights reserved.\n{body}" for body in bodies if len(words) < 3000]
    return list(dict.fromkeys([*bodies, *(f"{t}\n{b}" for t in TITLES.get(name, []) for b in bodies)]))


def notices() -> list[tuple[str, str]]:
    """(name, line) of the one-line notices."""
    return [(f"{name}-notice", opening + called) for name, calls in NOTICES.items()
            for called in calls for opening in OPENINGS]


def listed_digests() -> list[tuple[str, str]]:
    """(digest, name) of the table of the package: `forms` of common licences, and `notices`."""
    with open(DIGESTS, encoding="ascii") as lines:
        return [tuple(line.rstrip("\n").split(",")) for line in lines]


def spelled_words() -> str:
    """An expression for a word of `SPELLINGS` between blanks and line breaks."""
    heads = sorted({word[0] for word in SPELLINGS})
    ways = [f"{c}(?:{'|'.join(sorted(w[1:] for w in SPELLINGS if w[0] == c))})" for c in heads]
    return rf"(?:^|[ \n])(?:{'|'.join(ways)})(?:[ \n]|$)"


def plain_text(low: Column) -> Column:
    """A lower-cased text without copyright statements, other characters as single blanks; line
    breaks stay. Few texts have anything that looks like a statement; the others are left whole."""
    signed = low.contains("copyright") | low.contains("(c)") | low.contains("©")
    kept = F.array_join(F.filter(lines_of(low), lambda line: ~line.rlike(COPYRIGHT_LINE)), "\n")
    return F.regexp_replace(F.when(signed, kept).otherwise(low), r"[^\p{L}\p{N}\n]+", " ")


def line_forms(plain: Column) -> Column:
    """The canonical forms of the lines of a `plain_text` in order, empty ones left out."""
    known = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    spelled = F.transform(lines_of(plain), lambda line: F.array_join(F.transform(
        F.split(line, " "), lambda word: F.coalesce(F.try_element_at(known, word), word)), " "))
    # Few texts have a word to respell.
    lines = F.when(plain.rlike(spelled_words()), spelled).otherwise(lines_of(plain))
    return F.array_remove(F.transform(lines, lambda line: F.trim(line)), "")


def canonical(text: Column) -> Column:
    """The canonical form of a text or line."""
    return F.array_join(line_forms(plain_text(lower_ascii(text))), " ")


def known_digests(spark: SparkSession, known: dict[str, str]) -> dict[str, str]:
    """digest -> name of the known texts; of two of one form the first name in order counts."""
    if not known:
        return {}
    texts = spark.createDataFrame(sorted(known.items(), reverse=True), "name string, text string")
    forms = texts.select("name", canonical(F.col("text")).alias("form")).filter("form <> ''")
    return {r["digest"]: r["name"] for r in sorted(forms.select(
        "name", F.sha2("form", 256).alias("digest")).collect(), reverse=True)}


def digest_rows(spark: SparkSession, texts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(digest, name) of (name, text) rows, sorted; of names of one form the first counts."""
    made = spark.createDataFrame(texts, "name string, text string").select(
        "name", canonical(F.col("text")).alias("form")).filter("form <> ''")
    return sorted(map(tuple, made.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("name")).collect()))


def licence_scan(docs: DataFrame, known: dict[str, str] | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: id, digest, licence, n_licence_lines, line_licences.

    `licence` names the known licence whose canonical form the whole text has, else null;
    `line_licences` those that single lines have, in order and each once, comma-joined. A null
    text is empty; an empty form has a digest and matches nothing. Rows that repeat an id are
    looked up each by itself. Extra columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    names = known_digests(spark, LICENCES if known is None else known)
    names = {**dict(listed_digests()), **names} if known is None else names
    table = spark.createDataFrame(list(names.items()), "digest string, licence string")
    rows = docs.select(F.col(id_col).alias("__id"), lower_ascii(filled(F.col(text_col))).alias("low"))
    rows = rows.select("__id", plain_text(F.col("low")).alias("plain"))
    rows = rows.select("__id", line_forms(F.col("plain")).alias("forms"))
    rows = rows.select("__id", F.sha2(F.array_join("forms", " "), 256).alias("digest"), F.transform(
        "forms", lambda form: F.sha2(form, 256)).alias("lines"))
    none = F.array().cast("array<string>")
    # A list of constants is one hash set, however long.
    rows = rows.withColumn("lines", F.filter("lines", lambda line: line.isin(*names)) if names else none)
    called = F.from_json(F.lit(json.dumps(names)), "map<string,string>")
    named = F.transform("lines", lambda line: F.try_element_at(called, line))
    # The table is as long as the caller's list of licences, whatever the number of documents.
    return rows.join(F.broadcast(table), "digest", "left").select(
        F.col("__id").alias(id_col), "digest", "licence",
        F.size("lines").cast("long").alias("n_licence_lines"),
        F.array_join(F.array_sort(F.array_distinct(named)), ",").alias("line_licences"))
