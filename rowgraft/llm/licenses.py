"""Whole texts that are a known licence; DataFrame functions only.

A text is put in canonical form (lower case, copyright lines gone, runs of anything but
letters and digits one blank, equivalent spellings one spelling) and digested; digests are
hash-joined to those of known licences.  Nothing but the digest is exchanged.

Known licences are a table (license_id, text): the short ones listed here, each with and without
its usual titles and the numbers of its paragraphs, and whole texts read from a folder.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgraft.llm.common import free_name

# Spellings that count as the same word (left) and the one they become (right),
# after the public matching guidelines for licence texts.
SPELLINGS = {
    "acknowledgment": "acknowledgement", "analog": "analogue", "analyze": "analyse", "artifact": "artefact",
    "authorization": "authorisation", "authorized": "authorised", "caliber": "calibre", "canceled": "cancelled",
    "capitalizations": "capitalisations", "catalog": "catalogue", "categorize": "categorise", "center": "centre",
    "emphasized": "emphasised", "favor": "favour", "favorite": "favourite", "fulfill": "fulfil", "fulfillment": "fulfilment",
    "https": "http", "initialize": "initialise", "judgment": "judgement", "labeling": "labelling", "labor": "labour",
    "license": "licence", "licensed": "licenced", "licenses": "licences",
    "maximize": "maximise", "modeled": "modelled", "modeling": "modelling", "offense": "offence", "optimize": "optimise",
    "organization": "organisation", "organize": "organise", "practice": "practise", "program": "programme",
    "realize": "realise", "recognize": "recognise", "signaling": "signalling", "sublicense": "sublicence",
    "sublicenses": "sublicences", "utilization": "utilisation", "while": "whilst", "wilfull": "wilful",
}

# Texts of public licences.
_PERMISSION = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = {
    "0BSD": f"{_PERMISSION}.\n\n{_ISC_END}",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": f"{_BSD_HEAD}\n\n1. {_BSD_1}\n\n2. {_BSD_2}\n\n{_BSD_END}",
    "BSD-3-Clause": f"{_BSD_HEAD}\n\n1. {_BSD_1}\n\n2. {_BSD_2}\n\n3. {_BSD_3}\n\n{_BSD_END}",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": f"{_PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT line": "Released under the MIT License.",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
}

# Headings that stand above these licences.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"], "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License"], "ISC": ["ISC License", "The ISC License"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "Zlib": ["zlib License", "The zlib License"],
}

#: A line that states a copyright (a mark, a year or a place for one follows), or only the usual
#: sentence after it.  Lines of a licence's body that happen to begin with the word stay.
COPYRIGHT = r"(?m)^[ \t]*(copyright[ \t:]*(\(c\)|©|[0-9]{4}|<|\[|\{)|(\(c\)|©)[ \t]*(copyright|[0-9]{4}|<|\[)|all rights reserved[. \t]*$).*$"
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The words of a text in canonical form, joined by blanks; null counts as the empty text."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT, " ")
    words = F.split(F.trim(F.regexp_replace(plain, OTHER, " ")), " ")
    spelling = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(spelling, w), w)), " ")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def variants(known: dict[str, str] = KNOWN) -> list[tuple[str, str]]:
    """(license_id, text) of each text as listed, with each of its titles, and all of these with
    paragraphs that begin with marks instead of numbers."""
    found = []
    for license_id, text in sorted(known.items()):
        plain = re.sub(r"(?m)^[0-9]+\. ", "* ", text)
        for body in dict.fromkeys((text, plain)):
            found += [(license_id, body), *[(license_id, f"{title}\n\n{body}") for title in TITLES.get(license_id, [])]]
    return found


def known_licenses(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """license_id, text of the licences listed here and, as whole texts, of the files in a folder
    that Spark can read, named by their licences (Apache-2.0.txt)."""
    listed = spark.createDataFrame(variants(), "license_id string, text string")
    if folder is None:
        return listed
    files = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.txt)?$", 1).alias("license_id"), F.col("value").alias("text"))
    return listed.unionByName(files)


def license_matches(docs: DataFrame, licenses: DataFrame, text: str = "text") -> DataFrame:
    """Every row with ``digest`` and ``license_id`` (null: not a known licence).

    A null or empty text, or one of nothing but copyright lines, has the digest of no words
    and matches nothing.  Licences with the same canonical text are one row: the smallest
    license_id.  Copies match alike.  An empty table on either side is fine.  Columns of
    ``docs`` that have these names keep them; the new ones get a trailing underscore.
    """
    name, license_id = free_name(docs, "digest"), free_name(docs, "license_id")
    known = licenses.where(canonical(F.col("text")) != "").groupBy(digest(F.col("text")).alias(name)).agg(F.min("license_id").alias(license_id))
    return docs.withColumn(name, digest(F.col(text))).join(known, name, "left").select(*docs.columns, name, license_id)
