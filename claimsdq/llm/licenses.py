"""Licence scan by canonical digest lookup.

A text is brought to canonical form: A-Z lower-cased, typographic quotes,
dashes made plain, copyright statements and "all rights reserved" removed, equivalent spellings made one, punctuation and blanks made
single spaces.  Two texts with one canonical form are the same licence, so the
SHA-256 of the form is looked up in a table of known licence digests by a hash
join.  What is looked up is always an entire text: the document as a whole,
and each of its lines as a text of its own (notices stand on one line).

The known table holds a fixed list of licences, not data, so it is broadcast:
the full texts and headers of ``license_texts``, SPDX tags, and the usual notices
("licensed under ...") made from each licence's names.
Lines never leave their task: the aggregate by document is partial before its
small rows are exchanged, so one line that every document has costs nothing
extra.

A copyright statement is "copyright" with "(c)", the sign or a year, "(c)" with a
year, or the sign, anywhere, or "copyright" with an owner at a line's start.  It
reaches to the end of its line or sentence, to a word that begins a licence
("Permission", "Licensed") or over 30 words.  "Copyright notice", "holder", "law"
and the like are the licence's own words and stay, and statements within the
licences go with their own words only, so the form does not depend on wrapping.

Edge cases: null and blank texts have an empty form, which matches nothing;
rows that repeat a ``doc_id`` with the same text are reported once; two known
licences with one form are reported under the smaller name; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsdq.llm.common import text_or_empty
from claimsdq.llm.license_texts import TEXTS

# Spellings that count as one, written (from, to).
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("copyright owner", "copyright holder"),
    ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"), ("favour", "favor"),
    ("organisation", "organization"), ("merchantibility", "merchantability"), ("non infring", "noninfring"),
    ("whilst", "while"), ("wilful", "willful"), ("per cent", "percent"), ("https", "http"),
)
# Characters made plain before punctuation goes, and what they become.
TYPOGRAPHIC = "\u2018\u2019\u201c\u201d\u2013\u2014\u2026\u00a0"
PLAIN = "''\"\"--. "
COPYRIGHT_MARKS = ("copyright", "(c)", "©")
# Words that end a copyright statement, and words after "copyright" that make it
# a word of the licence and not the mark of a statement.
AFTER_STATEMENT = ("anyone", "distributed", "everyone", "licensed", "permission", "redistribution", "redistributions", "released",
                   "see", "spdx-license-identifier:", "this", "unless", "use", "you")
NO_OWNER = (
    "also", "and", "are", "as", "disclaimer", "doctrine", "doctrines", "doctrin", "for", "from", "if", "in", "including", "interest", "interests",
    "is", "law", "laws", "license", "licenses", "licence", "line", "lines", "notice", "notices", "of", "on", "or", "owner", "owners", "ownership",
    "holder", "holders", "permission", "protection", "resulting", "right", "rights", "statement", "statements", "status", "that", "the", "to",
    "treaties", "treaty", "under", "where", "which", "with", "without", "year")
_TOKEN, _BLANK, _ANY = r"[^\x20\t\r\n]", r"[\x20\t\r]", r"[\x20\t\r\n]+"


def _other_than(words: tuple[str, ...], bare: bool, root: bool = True) -> str:
    """A pattern, without lookahead, of the tokens other than ``words``: they
    leave the words' tree by a character of their own, or end within a word.
    ``bare``: a word with marks behind it counts as the word, and a token starts
    with a letter; otherwise a token does not end in a full stop."""
    heads = "".join(dict.fromkeys(w[0] for w in words if w))
    other = "".join("\\" + c if c in "-:" else c for c in heads) + r"\x20\t\r\n"
    ends = "" in words
    if bare:
        first = r"0-9(<\[\x{A9}\x22_.:*/-" if root else ""
        own = f"[{''.join(c for c in string.ascii_lowercase + string.digits if c not in heads)}]" if ends else f"[^{first}{other}]"
        out = [own + _TOKEN + "*"]
    else:
        out = [f"[^{other}.](?:{_TOKEN}*[^\\x20\\t\\r\\n.])?", f"\\.{_TOKEN}*[^\\x20\\t\\r\\n.]"]
    out += [re.escape(c) + _other_than(tuple(w[1:] for w in words if w[:1] == c), bare, False) for c in heads]
    if not root and not ends:
        out.append("")
    return f"(?:{'|'.join(out)})"


def _statement() -> str:
    year = r"(?:1[89]|20)[0-9]{2}"
    by = r"(?:\(c\)|\x{A9})"
    word = f"(?:{_other_than(AFTER_STATEMENT, False)}|{_TOKEN}{{1,4}}\\.)"     # "x." and "inc." end no sentence
    tail = f"(?:{word}{_BLANK}+){{0,30}}(?:{_TOKEN}+\\.(?:[\\x20\\t\\r\\n]|\\z)|{word}(?:\\n|\\z))?"
    inside = "|".join(x.replace(" ", _ANY) for x in (               # statements of the licences themselves
        rf"copyright {by} {year}(?:,(?: )?{year})* free software foundation,? inc\.?,?(?: <https?://fsf\.org/>)?",
        r"copyright \(c\) (?:<year>|year|yyyy|19yy|19xx) (?:<name of author>|name of author|your name\.?)",
        r"copyright \(c\) _+ _+\.?", r"copyright \[yyyy\] \[name of copyright owner\]",
        rf"copyright \x{{A9}} {year}-{year} unicode, inc\."))
    marks = "|".join((rf"copyright:?{_BLANK}*{by}(?:{_ANY}{year})?{_TOKEN}*", rf"copyright:?{_ANY}{year}{_TOKEN}*",
                      rf"\(c\){_BLANK}*(?:copyright{_BLANK}+)?{year}{_TOKEN}*", rf"\x{{A9}}(?:{_BLANK}*{year})?{_TOKEN}*"))
    line = rf"^[^a-z0-9\x{{80}}-\x{{10FFFF}}\n]*copyright:?{_BLANK}+{_other_than(NO_OWNER, True)}"
    return f"(?m)(?:{inside}|(?:{marks}){_BLANK}*{tail}|{line}(?:\\n|\\z|{_BLANK}+{tail}))"


# Statements of who owns the text: dropped up to the end of their sentence or line.
COPYRIGHT_LINE = _statement()
PUNCTUATION = r"[^a-z0-9\x{80}-\x{10FFFF}]+"

# Licences by the names that notices use, beside their SPDX tag.
NAMES = {
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3", "AGPL v3"),
    "AGPL-3.0-or-later": ("GNU Affero General Public License, version 3 or later", "AGPL version 3 or later"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache 2.0",
                   "Apache 2", "Apache License 2"),
    "Artistic-1.0": ("Artistic License 1.0",),
    "Artistic-2.0": ("Artistic License 2.0",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "CC0 1.0 Universal Public Domain Dedication",
                "Creative Commons Zero v1.0 Universal"),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, Version 2.0"),
    "EUPL-1.2": ("European Union Public License 1.2", "EUPL v1.2"),
    "ISC": ("ISC License",),
    "MIT": ("MIT License", "Expat License"),
    "MPL-1.1": ("Mozilla Public License 1.1", "Mozilla Public License, Version 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License, Version 2.0", "MPL 2.0"),
    "NCSA": ("University of Illinois/NCSA Open Source License",),
    "OFL-1.1": ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"),
    "Unicode-3.0": ("Unicode License v3",),
    "Unlicense": ("The Unlicense",),
    "WTFPL": ("Do What The Fuck You Want To Public License",),
    "Zlib": ("zlib License",),
}
for _id, _short, _long in (("GPL", "GPL", "General Public License"), ("LGPL", "LGPL", "Lesser General Public License"),
                           ("GFDL", "GFDL", "Free Documentation License")):
    for _v in {"GPL": ("1.0", "2.0", "3.0"), "LGPL": ("2.1", "3.0"), "GFDL": ("1.2", "1.3")}[_id]:
        _n = _v.removesuffix(".0")
        _plain = tuple(f"{name}{join}{v}" for name in (_short, f"GNU {_short}", f"GNU {_long}")
                       for join in (" ", " v", " version ") for v in dict.fromkeys((_n, _v))) + (f"{_short}v{_n}", f"GNU {_short}v{_n}")
        NAMES[f"{_id}-{_v}"] = _plain
        NAMES[f"{_id}-{_v}-or-later"] = tuple(f"{name} or {later}" for name in _plain if not name.endswith(".0")
                                              for later in ("later", "any later version"))
for _code, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                      ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v, _kind in (("3.0", "Unported"), ("4.0", "International")):
        NAMES[f"CC-{_code}-{_v}"] = tuple(
            f"{name} {_v}{kind}" for kind in ("", f" {_kind}")
            for name in (f"CC {_code}", f"Creative Commons {_code}", f"Creative Commons {_words}"))

# What stands before the name of a licence in a notice.
SUBJECTS = ("", "This work is ", "This project is ", "This software is ")
VERBS = ("Licensed under ", "Released under ", "Distributed under ")
ARTICLES = ("", "the ", "a ")


def notices() -> list[tuple[str, str]]:
    """(licence, notice) of the names: SPDX tags, "License: x", names that say
    "License" or a version, and sentences with and without "license" at the end."""
    out = []
    for tag, names in NAMES.items():
        tags = [tag, f"{tag}-only"] if tag in ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GFDL-1.2", "GFDL-1.3") else [tag]
        out += [(tag, f"SPDX-License-Identifier: {t}") for t in tags]
        for name in dict.fromkeys((*tags, *names)):
            ended = [name] if "license" in name.lower() or " or " in name else [name, f"{name} License"]
            out += [(tag, f"License: {n}") for n in ended]
            out += [(tag, n) for n in ended if "license" in n.lower() or any(c.isdigit() for c in n)]
            out += [(tag, s + (v.lower() if s else v) + a + n) for n in ended for s in SUBJECTS for v in VERBS
                    for a in ARTICLES if not (a == "a " and not tag.startswith("CC-"))]
    seen = {}
    for tag, n in out:
        seen.setdefault("".join(c if c.isalnum() else " " for c in n.lower()), (tag, n))
    return list(seen.values())


# Licence texts and one-line notices.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    *TEXTS,
    *notices(),
)


def _any_of(text: Column, parts) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: text.contains(p))


def canonical(df: DataFrame, text: str, form: str) -> DataFrame:
    """Add ``form``: the canonical form of ``text``, empty if it holds no letter
    or digit.  Each step is a column of its own, so that no expression is
    computed twice; a plain search tells the many texts that need no pattern
    from the few that do."""
    df = df.withColumn(form, F.translate(text, string.ascii_uppercase + TYPOGRAPHIC, string.ascii_lowercase + PLAIN))
    t = F.col(form)
    for step in (
            F.when(_any_of(t, COPYRIGHT_MARKS), F.regexp_replace(t, COPYRIGHT_LINE, " ")).otherwise(t),
            F.replace(F.trim(F.regexp_replace(t, PUNCTUATION, " ")), F.lit("all rights reserved"), F.lit("")),
            F.when(_any_of(t, [old for old, _ in SPELLINGS]), _respelled(t)).otherwise(t),
            F.trim(F.when(t.contains("  "), F.regexp_replace(t, " +", " ")).otherwise(t))):
        df = df.withColumn(form, step)
    return df


def _respelled(text: Column) -> Column:
    pairs = F.array(*[F.struct(F.lit(old).alias("old"), F.lit(new).alias("new")) for old, new in SPELLINGS])
    return F.aggregate(pairs, text, lambda t, p: F.replace(t, p["old"], p["new"]))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``digest, license`` of the known texts, one row per digest."""
    rows = spark.createDataFrame([(n, t) for n, t in known], "license string, known_text string")
    return canonical(rows, "known_text", "form").filter("form != ''") \
        .groupBy(F.sha2("form", 256).alias("known_digest")).agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, known=KNOWN) -> DataFrame:
    """Per document: ``doc_id``, ``text_digest`` (canonical form of the whole
    text), ``text_license`` (null if unknown), ``licenses`` (all that the text
    or a line matched, sorted, comma-joined) and ``n_license_lines``."""
    text = text_or_empty()
    units = docs.select("doc_id", F.sha2(text, 256).alias("__text"),
                        F.posexplode(F.concat(F.array(text), F.split(text, "\n", -1))).alias("__at", "__unit"))
    units = canonical(units, "__unit", "__form") \
        .select("doc_id", "__text", "__at", F.sha2("__form", 256).alias("digest"),
                (F.col("__form") == "").alias("blank"))
    found = units.join(F.broadcast(known_digests(docs.sparkSession, known)),
                       (F.col("digest") == F.col("known_digest")) & ~F.col("blank"), "left")
    whole = F.col("__at") == 0
    line = F.when(~whole & F.col("license").isNotNull(), F.col("__at"))
    return found.groupBy("doc_id", "__text").agg(
        F.max(F.when(whole, F.col("digest"))).alias("text_digest"),
        F.max(F.when(whole, F.col("license"))).alias("text_license"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
        F.count(line).alias("n_license_lines"),
        F.count(F.when(whole, 1)).alias("copies")) \
        .select("doc_id", "text_digest", "text_license", "licenses",
                F.floor(F.col("n_license_lines") / F.col("copies")).alias("n_license_lines"))
