"""Licence texts by canonical digest, in DataFrame functions only.

A text is lower-cased, copyright lines are taken out, spellings made one, and
everything that is no letter or digit becomes one blank. The SHA-256 of what is
left is looked up among the digests of known licence texts, which are made by the
same expression from a list the caller may extend.

Licence files also carry a title, holder lines without a year, other list marks and
the holder's name inside the text. A text whose canonical form is not known is looked
up once more by its bare form, which has none of these.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Lines that name a holder or a year, or that only reserve rights.
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n©(]*(copyright[ \t]*(\([ \t]*c[ \t]*\)|©|:|[0-9]{4})|©|\([ \t]*c[ \t]*\)[ \t]*[0-9]{4})[^\n]*$"
RESERVED = r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
#: Spellings that stand for the same word; applied in this order.
SPELLINGS = {"licence": "license", "organisation": "organization", "authoris": "authoriz", "favour": "favor",
             "behaviour": "behavior", "whilst": "while", "https://": "http://", "&": " and ", "non-": "non",
             "sub-": "sub", "merchantibility": "merchantability"}

_NAME = (r"(?:mit|expat|x11|isc|zlib(?:/libpng)?|0bsd|(?:bsd[ -])?(?:[0-4]|zero|two|three)[ -]clause(?:[ -]bsd)?"
         r"|(?:(?:new|modified|revised|simplified|free)[ -]?)?bsd(?:[ -](?:[0-4]|zero|two|three)[ -]clause)?|apache|the unlicense"
         r"|gnu (?:lesser |library )?general public|mozilla public)")
_BRACKET = r"(?:[ \t]*[(\[][^\n)\]]{1,40}[)\]])?"
_LINE = r"[^\p{L}\p{N}\n]*"
#: Lines before the text: names of licences, holders, and lines without a word.
HEAD = (rf"\A(?:{_LINE}(?:(?:the )?(?:{_NAME}(?: licen[sc]e)?|licen[sc]e(?:: *{_NAME}(?: licen[sc]e)?)?){_BRACKET}{_LINE}"
        rf"|(?:portions )?(?:copyright|©)\b[^\n]*)?(?:\n|\z)){{1,80}}")
#: A paragraph of one line that begins as a holder's does, and places to be filled in with one.
HOLDER = rf"(?m)(^{_LINE}\n){_LINE}copyright\b[^\n]*(?=\n{_LINE}$)|^{_LINE}copyright[ \t]*[\[{{<][^\n]*$"
#: Numbers of list items, and the address that editions of one text differ in.
ITEM = r"(?m)^[^\p{L}\p{N}\n]*[0-9]{1,2}[.)](?=[ \t])"
ADDRESS = r"(?:51 franklin st|59 temple place)[^\n]*"
#: Words of a canonical form that name a holder, and what they are made; applied in this order.
NAMED = {r"neither the names? of .{1,120}? nor the names of (?:its|their|any|other) contributors":
         "neither the name of the copyright holder nor the names of its contributors",
         r"\bcopyright (?:owners?|holders?) (and|or) contributors": "copyright holder $1 contributors"}

# Texts as their owners publish them, and short notices that stand for one.
KNOWN = {
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
    "notice:Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "notice:MIT": "Released under the MIT License.",
    "notice:CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "notice:GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
}


def _whole_texts() -> list[tuple[str, str]]:
    """(license_id, text) of ``KNOWN`` and of the files beside this one, these also without what follows their terms."""
    end = "END OF TERMS AND CONDITIONS"
    out = [*KNOWN.items(), ("ISC", KNOWN["ISC"].replace("and/or distribute", "and distribute", 1))]
    for file in resources.files(__package__).joinpath("license_texts").iterdir():
        text = file.read_text(encoding="utf-8")
        name = file.name.removesuffix(".txt")
        out += [(name, text)] + [(name, text.split(mark)[0] + rest) for mark, rest in ((end, end), (end, ""))
                                 if mark in text]
    return sorted(out)


def _without_holders(text: Column) -> Column:
    c = F.lower(F.coalesce(text, F.lit("")))
    return F.regexp_replace(F.regexp_replace(c, COPYRIGHT, " "), RESERVED, " ")


def _spelt(c: Column) -> Column:
    for other, one in SPELLINGS.items():
        c = F.replace(c, F.lit(other), F.lit(one))
    return F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "))


def canonical(text: Column) -> Column:
    """The canonical form of a text; null is the empty text."""
    return _spelt(_without_holders(text))


def bare(text: Column) -> Column:
    """The canonical form without title and holder lines, list numbers and holders' names; null is the empty text."""
    c = F.regexp_replace(F.replace(_without_holders(text), F.lit("\r"), F.lit("")), HEAD, "")
    c = _spelt(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, HOLDER, "$1 "), ITEM, " "), ADDRESS, " "))
    for pattern, one in NAMED.items():
        c = F.regexp_replace(c, pattern, one)
    return c


def known_digests(spark: SparkSession, texts: Mapping[str, str] | Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """(license_id, digest) of canonical and bare forms; of names with one digest the smallest stays."""
    pairs = _whole_texts() if texts is None else sorted(texts.items() if isinstance(texts, Mapping) else texts)
    held = spark.createDataFrame(pairs, "license_id string, text string")
    digests = F.array(*[F.sha2(form(F.col("text")), 256) for form in (canonical, bare)])
    return held.select("license_id", F.explode(digests).alias("digest")).groupBy("digest").agg(
        F.min("license_id").alias("license_id"))


def scan(df: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, canonical_sha256, n_words (of the canonical form), license_id (null: no known text).

    Whole texts are compared, by canonical form and then by bare form. ``known``
    has license_id and digest, one row per digest. Null, empty and wordless texts share the digest of nothing and match
    only if that is listed. One row per input row; other columns are ignored; an
    empty table gives no rows. Rows are joined on the digest: a small ``known`` is
    broadcast by its size, else both sides are shuffled and skew is split.
    """
    known = known_digests(df.sparkSession) if known is None else known
    form = df.select(df[id_col], canonical(df[text_col]).alias("form"), bare(df[text_col]).alias("bare"))
    rows = form.select(id_col, F.sha2("form", 256).alias("canonical_sha256"), F.when(F.col("form") == "", 0).otherwise(
        F.length("form") - F.length(F.replace("form", F.lit(" "), F.lit(""))) + 1).cast("bigint").alias("n_words"),
        F.when(F.col("bare") != "", F.sha2("bare", 256)).otherwise(F.sha2("form", 256)).alias("bare_sha256"))
    first, second = (known.select(F.col("digest").alias(f"d_{k}"), F.col("license_id").alias(f"by_{k}")) for k in ("form", "bare"))
    return (rows.join(first, rows["canonical_sha256"] == first["d_form"], "left")
            .join(second, rows["bare_sha256"] == second["d_bare"], "left")
            .select(id_col, "canonical_sha256", "n_words", F.coalesce("by_form", "by_bare").alias("license_id")))


def canonical_sql(text: str) -> str:
    """The canonical form in the checking engine's SQL."""
    c = f"lower(coalesce({text}, ''))"
    for pattern in (COPYRIGHT, RESERVED):
        c = f"regexp_replace({c}, '{pattern}', ' ', 'g')"
    for other, one in SPELLINGS.items():
        c = f"replace({c}, '{other}', '{one}')"
    return rf"trim(regexp_replace({c}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
