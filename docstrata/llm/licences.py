"""Licence scans by canonical digest.

A text is brought into a canonical form: lower case, without lines that state a
copyright, with one spelling for equivalent words and one space for whatever is
neither letter nor digit. Its digest is joined with those of the known licences: the
entire text of a document, and each of its lines for one-line notices.

Lines are looked up before anything is shuffled, so only lines that are known notices
leave their task, whichever document they are from.

Defined cases: a null or empty text, or one of copyright lines only, matches nothing;
repeated rows each get their result, also where rows share a doc_id;
licences that are equal in canonical form are reported under the first name.
"""

from __future__ import annotations

import pathlib
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstrata.llm.tables import pick, small_side

# Spellings that count as equal in licence texts, the second one is kept.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analyse", "analyze"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("cancelled", "canceled"),
    ("centre", "center"),
    ("colour", "color"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("labelled", "labeled"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("merchantibility", "merchantability"),
    ("modelled", "modeled"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("utilise", "utilize"),
    ("whilst", "while"),
    ("wilful", "willful"),
)
# Licences by the names used in notices.
NAMED = (
    "Apache License, Version 2.0",
    "BSD 2-Clause License",
    "BSD 3-Clause License",
    "CC BY 4.0",
    "CC BY-NC 4.0",
    "CC BY-SA 4.0",
    "GNU Affero General Public License, version 3",
    "GNU General Public License, version 2",
    "GNU General Public License, version 3",
    "GNU Lesser General Public License, version 3",
    "ISC License",
    "MIT License",
    "Mozilla Public License 2.0",
)
# How notices name a licence.
NOTICES = ("Licensed under {}", "Released under {}", "This work is licensed under {}", "Distributed under {}")
# The texts of short licences, without copyright lines.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}
TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace(
    "distribution.\n",
    """distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
""",
)
# Title lines that files put above these texts.
TITLES = {
    "MIT": ("MIT License", "MIT License (MIT)", "The MIT License", "The MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "ISC License (ISC)", "ISC License (ISCL)", "The ISC License", "The ISC License (ISC)", "ISC"),
    "0BSD": (
        "0BSD",
        "BSD Zero Clause License",
        "BSD Zero Clause License (0BSD)",
        "Zero-Clause BSD",
        "Zero-Clause BSD License",
    ),
    "Zlib": ("zlib", "zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
    "BSD-2-Clause": (
        "BSD License",
        "BSD 2-Clause",
        "BSD 2-Clause License",
        "The BSD 2-Clause License",
        'BSD 2-Clause "Simplified" License',
        "Simplified BSD License",
    ),
    "BSD-3-Clause": (
        "BSD License",
        "BSD 3-Clause",
        "BSD 3-Clause License",
        "The BSD 3-Clause License",
        'BSD 3-Clause "New" or "Revised" License',
        "Modified BSD License",
        "New BSD License",
        "Revised BSD License",
    ),
}
# The entire files of long licences, title lines included, by name.
FILES = pathlib.Path(__file__).with_name("licence_texts")

# ASCII punctuation, blanks other than line feeds, and typographic signs become blanks.
PUNCTUATION = "\t\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\u00a0" + "".join(
    map(chr, [*range(0x2010, 0x2020), 0x2022, 0x2026])
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(?m)^ *(?:copyright *(?:c |©|[0-9]{4}|by )|c +[0-9]{4}|©|all rights reserved)[^\n]*$"


def canonical_lines(text: Column) -> Column:
    """The lines of a text in the form in which licences are compared, without empty
    ones."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER + PUNCTUATION, LOWER + " " * len(PUNCTUATION))
    out = F.regexp_replace(out, F.lit(COPYRIGHT_LINE), F.lit(""))
    out = F.concat(F.lit(" "), F.replace(out, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    # Two blanks between words, so that each has its own and neighbours are both replaced.
    out = F.regexp_replace(out, F.lit(" +"), F.lit("  "))
    for other, kept in SPELLINGS:
        out = F.replace(out, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {kept} "))
    out = F.replace(out, F.lit("  "), F.lit(" "))
    lines = F.transform(F.split(out, "\n"), lambda line: F.trim(line))
    return F.filter(lines, lambda line: line != "")


def digest(lines: Column) -> Column:
    """Of an entire text given by its lines; NULL if there is none."""
    return F.when(F.size(lines) > 0, F.sha2(F.array_join(lines, " "), 256))


def known_texts() -> list[tuple[str, str]]:
    """Built-in licences: (name, text), entire texts with and without a title line, and
    one-line notices."""
    forms = [(name, form) for name, text in TEXTS.items() for form in wordings(name, text)]
    titled = [(name, f"{title}\n{form}") for name, form in forms for title in TITLES[name]]
    files = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(FILES.glob("*.txt"))]
    notices = [
        (name, notice.format(article + name))
        for name in NAMED
        for notice in NOTICES
        for article in ("", "the ")
    ]
    return [*forms, *titled, *files, *notices]


def wordings(name: str, text: str) -> list[str]:
    """A text in its usual wordings: the BSD licences with numbers or bullets, and with
    the holder or the owner of the copyright not liable."""
    if not name.startswith("BSD-"):
        return [text]
    both = [text, re.sub(r"(?m)^[0-9]\. ", "* ", text)]
    return [*both, *(t.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR") for t in both)]


def known_digests(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """Rows (digest, licence), one per digest; ``texts`` has (licence, text)."""
    if texts is None:
        rows = F.array(*(F.struct(F.lit(n).alias("licence"), F.lit(t).alias("text")) for n, t in known_texts()))
        texts = spark.range(1).select(F.inline(rows))
    lines = pick(texts, "licence", "text").select("licence", canonical_lines(F.col("text")).alias("lines"))
    form = lines.select("licence", digest(F.col("lines")).alias("digest"))
    return form.where("digest IS NOT NULL").groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """For each document the digest and licence of its entire text and the sorted names
    in its one-line notices: doc_id, digest, licence, notices.

    Texts are read once: their own digest and those of their lines meet the known ones
    in one join, and what is not a known notice ends there.
    """
    known = known_digests(docs.sparkSession, texts)
    known = F.broadcast(known) if texts is None else small_side(known, 128)
    rows = pick(docs, "doc_id", "text").select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    rows = rows.select("doc_id", "lines", digest(F.col("lines")).alias("whole"))
    one = F.struct(F.col("whole").alias("digest"), F.lit(True).alias("entire"))
    each = F.transform(
        "lines", lambda line: F.struct(F.sha2(line, 256).alias("digest"), F.lit(False).alias("entire"))
    )
    looked_up = rows.select("doc_id", "whole", F.inline(F.concat(F.array(one), each)))
    met = looked_up.join(known, "digest", "left").where("entire OR licence IS NOT NULL")
    found = met.groupBy("doc_id", F.col("whole").alias("digest")).agg(
        F.max(F.when(F.col("entire"), F.col("licence"))).alias("licence"),
        F.array_sort(F.collect_set(F.when(~F.col("entire"), F.col("licence")))).alias("notices"),
        F.count_if("entire").alias("copies"),
    )
    return found.select(
        "doc_id", "digest", "licence", "notices", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    ).drop("copy")
