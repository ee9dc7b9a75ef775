"""License scans by canonical digest lookup.

A text is brought to a canonical form: lower case; lines that only state a
copyright go; punctuation becomes a space; equivalent spellings become one;
white space is squeezed.  Its SHA-256 is joined with the digests of known
licence texts and notices.  The whole text of a document is looked up, and
each of its lines, as notices mostly stand on a line of their own.

The known texts are fixed (``known_licenses``: under 500 rows), so their
digests are broadcast.  Long texts lie in ``license_texts``.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import row_key

# Equivalent spellings, applied in this order to lower-case text without punctuation.
EQUIVALENTS = [
    (r"\blicence", "license"),
    (r"\blicenced\b", "licensed"),
    (r"\bsub license", "sublicense"),
    (r"\bnon infringement\b", "noninfringement"),
    (r"\borganisation", "organization"),
    (r"\bfavour", "favor"),
    (r"\bcopyright holders?\b|\bcopyright owners?\b|\bauthors? or copyright holders?\b", "copyright holder"),
    (r"\bversion (?=[0-9])|\bv(?=[0-9] )|\bv (?=[0-9])", ""),
    (r"\b(?:this|the) (?:work|software|program|document|text|file|project|code) is (?:hereby )?", ""),
    (r"\b(?:released|distributed|published|made available|provided|available)(?= under )", "licensed"),
    (r"\bunder the terms of\b", "under"),
    (r"\bunder (?:the|an?) ", "under "),
]
# How a match of one of them can begin (a word, or the beginning of one).
EQUIVALENT_HEADS = ["licen", "sub", "non", "organi", "favo", "copyright", "author", "version", "v", "this", "the",
                    "released", "distributed", "published", "made", "provided", "available", "under"]
COPYRIGHT_LINE = r"(?im)^[^\S\n]*(?:[#*/;-]+[^\S\n]*)?(?:copyright\b|\(c\)|©)[^\n]*$|^[^\S\n]*all rights reserved\.?[^\S\n]*$"
COPYRIGHT_HEAD = r"(?i)^[^\p{L}\p{N}]*(?:©|copyright|c\)|all rights)"
PUNCTUATION = r"[^\p{L}\p{N}]+"

# Names by which notices refer to a licence.
NAMES = {
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License", "0BSD"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPLv3", "AGPL-3.0"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "BSD-3-Clause"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "CC0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "EPL-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPLv2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License version 3.0", "GNU GPLv3", "GPL-3.0"],
    "ISC": ["ISC License"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPLv3", "LGPL-3.0"],
    "MIT": ["MIT License", "MIT"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL-2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
}
NOTICES = ["Licensed under the {}", "SPDX-License-Identifier: {}", "License: {}", "{}"]

# Whole licence texts; further ones are the files of license_texts.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
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

For more information, please refer to <https://unlicense.org>""",
}
TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace("\n\nTHIS SOFTWARE", """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE""")
TERMS_END = "END OF TERMS AND CONDITIONS"  # what follows tells how to apply the licence, and is often left out


def license_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the whole texts: with and without what follows the terms, and each also with a line for a paragraph."""
    out = list(TEXTS.items())
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = path.read_text("utf-8")
        head, end, _ = text.partition(TERMS_END)
        out += [(path.stem, said) for said in ([text, head + end, head] if end else [text])]
    return out + [(i, re.sub(r"(?<=\S)[^\S\n]*\n(?=[^\S\n]*\S)", " ", text)) for i, text in out]


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(F.regexp_replace(text, COPYRIGHT_LINE, " ")), PUNCTUATION, " ")
    for pattern, said in EQUIVALENTS:
        out = F.regexp_replace(out, pattern, said)
    return F.trim(out)


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license_id, text) of the known licences, in canonical form."""
    rows = [(i, notice.format(name)) for i, names in NAMES.items() for name in names for notice in NOTICES]
    rows += [(i, title + text) for i, text in license_texts() for title in ("", f"{i} License\n\n", f"{NAMES[i][0]}\n\n")]
    known = spark.createDataFrame(rows, "license_id string, text string")
    return known.select("license_id", canonical(F.col("text")).alias("text"))


def _heads(known: DataFrame) -> str:
    """Pattern for the first words a text with a known digest can have.

    A canonical form begins with the first word of a known one, unless an
    equivalent was applied there: then the text begins as that one's pattern.
    """
    first = sorted(r["head"] for r in known.select(F.substring_index("text", " ", 1).alias("head")).distinct().collect())  # under 500 rows
    return f"^(?:{'|'.join([*first, *EQUIVALENT_HEADS])})"


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, license_id, n_notices, notices) for every row of ``docs`` (doc_id, text).

    ``license_id``: the licence that the whole text is, or null;
    ``n_notices``: lines that are a known notice; ``notices``: their licences,
    sorted, comma-joined, each once.  A null or empty text has no licence.
    Repeated rows are returned as often as they come, an empty table gives no
    rows, other columns are not looked at.  A very long text is canonicalised
    whole, by the JVM, in its row.
    """
    known = known_licenses(docs.sparkSession)
    heads = _heads(known)
    digests = F.broadcast(known.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("license_id").alias("license_id")))  # under 500 rows

    def digest(text: Column) -> Column:
        """Digest of the canonical form, or null if its beginning shows that it is unknown."""
        first = F.lower(F.regexp_extract(text, r"[\p{L}\p{N}]+", 0))
        return F.when(first.rlike(heads) | text.rlike(COPYRIGHT_HEAD), F.sha2(canonical(text), 256))

    base = row_key(docs.select("doc_id", "text")).withColumn("said", F.split(F.coalesce("text", F.lit("")), "\n"))
    lines = base.select("k1", "k2", F.posexplode("said").alias("line", "said"))
    lines = lines.select("k1", "k2", "line", digest(F.col("said")).alias("digest")).where("digest IS NOT NULL")
    found = (lines.join(digests, "digest").groupBy("k1", "k2")
             .agg(F.count_distinct("line").alias("n_notices"), F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices")))
    whole = base.select("doc_id", "k1", "k2", digest(F.col("text")).alias("digest")).join(digests, "digest", "left")
    return (whole.join(found, ["k1", "k2"], "left")
            .select("doc_id", "license_id", F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices")))
