"""Licence scan by canonical digest.

A text is brought to a canonical form (lower case; titles, copyright lines and
numbers of list items out; equivalent spellings and the holder named inside a
clause made one; punctuation and spacing out) and its digest is joined with the
digests of known licence texts brought to the same form. The join is on the whole
text: a document that merely holds a licence doesn't match.

Known texts lie in ``license_texts`` by their SPDX names, short ones below. Where
a text goes on after the end of its terms (how to apply it), it is also known
without that. A text can't tell "only" from "or later", so neither do the names.

Cases: null and empty texts, and texts of nothing but copyright lines, match
nothing; repeated rows are looked up alike; an empty table gives an empty result.
A copyright notice that runs over several lines loses its first line only; a text
whose holder takes more than twelve words inside a clause, or in which a wrap puts
a sentence's "copyright" before a name at the start of a line, isn't found.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.llm.common import text_of

#: Public licence texts, by their SPDX names.
LICENSES = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>""",
}
#: Spellings that count as one, and titles that a text may carry or not.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("sublicence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"), ("favour", "favor"), ("merchantibility", "merchantability"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("whilst", "while"), ("organisation", "organization"), ("https", "http"),
    ("and or", "and"), ("library general public", "lesser general public"),
)
#: Words after which "copyright" belongs to a sentence and doesn't start a notice.
IN_SENTENCE = (
    "and", "are", "as", "by", "claims?", "disclaimers?", "for", "holders?", "if", "in", "infringement", "interests?", "is",
    "laws?", "licen[cs]es?", "notices?", "of", "on", "or", "owners?", "permission", "protection", "resulting", "statements?",
    "status", "that", "the (?:library|program|software|work)", "to", "treaty", "under", "with",
)
BOUND = rf"copyright[ \t]+({'|'.join(IN_SENTENCE)})\b"
COPYRIGHT_LINE = r"(?md)^[^a-z0-9\n]*(?:(?:portions )?copyright[ \t:]+[^\s]|(?:portions )?copyright©|\(c\)[ \t]*(?:copyright|[0-9<\[{])|©|all rights reserved)[^\n]*$"
TITLE_LINE = (
    r"(?md)^[^a-z0-9\n]*(?:the )?(?:new |modified |revised |simplified )?(?:mit|isc|zlib|expat|0?bsd)(?:[ -](?:[0-9]|zero)[ -]clause)?"
    r"(?: [\x22'(]?(?:simplified|new|revised|modified)[\x22')]?)? licen[cs]e(?: \([^)\n]*\))?[^a-z0-9\n]*$"
)
ITEM_NUMBER = r"(?md)^[^a-z0-9\n]*[0-9]{1,2}\.[ \t]+|\([0-9]{1,2}\)"
#: Who a clause names, in words of the canonical form, and what stands for it.
HOLDERS = (
    (r"\bneither the names? of (?:[^ ]+ ){1,12}nor the names? of (?:any |its |his |her |their )?contributors", "neither the name of the holder nor the names of contributors"),
    (r"\bsoftware is provided by (?:[^ ]+ ){1,12}as is\b", "software is provided by the holder as is"),
    (r"\bin no event shall (?:[^ ]+ ){1,12}be liable\b", "in no event shall the holder be liable"),
    (r"\bas is and (?:[^ ]+ ){1,12}disclaims? all\b", "as is and the holder disclaims all"),
    (r"\b(?:51 franklin st(?:reet)? fifth floor|59 temple place suite 330|675 mass ave) (?:boston|cambridge) ma [0-9]{5}(?: [0-9]{4})?(?: usa)?\b", ""),
)
END_OF_TERMS = "END OF TERMS AND CONDITIONS"


def canonical(column: str = "text") -> Column:
    """Lower case without title, copyright lines, item numbers and punctuation, one space between words, one spelling."""
    text = F.regexp_replace(F.lower(text_of(column)), "\\r\\n?", "\n")
    text = F.regexp_replace(F.regexp_replace(text, BOUND, "copyright-$1"), TITLE_LINE, "")
    text = F.regexp_replace(F.regexp_replace(text, COPYRIGHT_LINE, ""), ITEM_NUMBER, "")
    words = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    for spelling, one in SPELLINGS:
        words = F.replace(F.concat(F.lit(" "), words, F.lit(" ")), F.lit(f" {spelling} "), F.lit(f" {one} "))
        words = F.trim(words)
    for named, one in HOLDERS:
        words = F.regexp_replace(words, named, one)
    return F.trim(F.regexp_replace(words, " +", " "))


def digest(column: str = "text") -> Column:
    return F.sha2(canonical(column), 256)


def catalogue() -> list[tuple[str, str]]:
    """(license, text) of all known texts, sorted; one licence may have several."""
    texts = set(LICENSES.items())
    for file in resources.files(__package__).joinpath("license_texts").iterdir():
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        texts.add((name, text))
        if END_OF_TERMS in text:
            texts.add((name, text[: text.index(END_OF_TERMS) + len(END_OF_TERMS)]))
    return sorted(texts)


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license), one row per distinct digest, of ``texts`` or the whole catalogue."""
    table = spark.createDataFrame(catalogue() if texts is None else texts, "license string, text string")
    return table.select(digest().alias("known"), "license").groupBy("known").agg(F.min("license").alias("license"))


def scanned(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``docs`` without its text, with ``digest`` and ``license`` (null if unknown).

    The size of ``known`` is that of the catalogue of licences, whatever the documents.
    """
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(*rest, digest().alias("digest"))
    return rows.join(F.broadcast(known), F.col("digest") == F.col("known"), "left").drop("known")
