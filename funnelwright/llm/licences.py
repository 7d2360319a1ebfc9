"""Licence texts found by canonical digest, with built-in functions only.

A text is brought to a canonical form - case, punctuation, copyright lines and
equivalent spellings removed - and its digest is joined to the digests of known
licences. Whole documents and whole lines are looked up; a text that only
mentions a licence is not one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import documents

# Spellings that licence guidelines treat as equal.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sublicence": "sublicense",
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
    "noncommercial": "non commercial",
    "percent": "per cent",
}

# Notices and short licences, by public identifier; quotation marks are no part of a canonical text.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.",
    ),
]

# Canonical digests of the full licences and of their forms (see ``forms``), by public identifier.
DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "dbb777d3ad1fb948fbe99e6748cbd3fea3f269381f3f7efe3f4259a28a9269c9"),
    ("Apache-2.0", "37aa90548985ac0057637d42c3153e8b5d107a21d9556d7fbe60e3e426fdacaa"),
    ("Apache-2.0", "b0599382c8df4042e6943031a45e43201985e794ac50d0d80a9912f187f6da24"),
    ("Apache-2.0", "71f04798c18bedab6f7130c52e48c0ca7d51195d1125db7387572a7f913bc62f"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("Artistic-1.0-Perl", "4eaaa9e33aeef0af0ff83ab5edac0ad421a1da9cc861c564630460107b4b772c"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("CC0-1.0", "a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32"),
    ("GFDL-1.2-only", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.2-only", "8d636e2e2f248f9b102e9d9f78337901ec8bca3bfe91434cdcf261a01bf305b1"),
    ("GFDL-1.2-only", "aa8e67692652aa0ece49069f2f9dffde6690debb563e627bab22508062ff269c"),
    ("GFDL-1.2-only", "8ba1d3a5e77649f38fcf5eed49c963b94e6e5dd9030997c1b85bb7065eb316bc"),
    ("GFDL-1.3-only", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GFDL-1.3-only", "8b8b57bd195ed50d50edb5da1dd173b409fb9b075910c69726be7d0363c40008"),
    ("GFDL-1.3-only", "5b967c12b95f7d93d6f6004b6a40e177bcc0e67173d4cd222531f389cda0d765"),
    ("GFDL-1.3-only", "b26ac9ce9a4b4a24517e0f6069b823113eb7401ad3fe5934bdb1a8b533f70ba6"),
    ("GPL-1.0-only", "ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a"),
    ("GPL-1.0-only", "74d0cd23803c9754c36f6ca0e1af411b418ed6b6564e757472bf0d870a1b5d1b"),
    ("GPL-1.0-only", "7084d0106d209cde496701d21dfbe9bb489fd9bedf9778f3d718d2fe7377dfc7"),
    ("GPL-1.0-only", "cbe7331e93829cef2fc892c0c502d583fade2f252903c60120323b5d9d074d7f"),
    ("GPL-2.0-only", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-2.0-only", "1551b61aa183f987ecceedd8966ec1e9b2da3848f8862c2adedc0d82f41904ca"),
    ("GPL-2.0-only", "e96e14de9c3b9dd8fb9b9c693f78237578ae05d8105b2ec72bbc79daaac48990"),
    ("GPL-2.0-only", "3d6c536f38203f43d4f882a96f62d08ef68247a99702d48f1c232a3250b408c1"),
    ("GPL-3.0-only", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0-only", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0-only", "c50bb15c5f5e96b27d60ee792a7db1637c2e416eb98869999aab5af68506cd64"),
    ("GPL-3.0-only", "4868f466a3292b095d887ce2ca00548d3969efb48c33f6aced9a20c59f578c19"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0-only", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0-only", "aa06ce7f6e464e73e65ec0efa0bc575ef5bb7059ae0137ab610c2e57b32ca95c"),
    ("LGPL-2.0-only", "81ecf332fc652bb79c23397a1431c72d1f39f01ffdcec61843942283b44f4688"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1-only", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1-only", "e94f6c31379c2076fae91e236d6000ea55d918637fc8f30749aa0fe22a265c7f"),
    ("LGPL-2.1-only", "98d365a8217633113a201b5777e4d26ae0eb1d88079c5e39838162abe1f18db4"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("LGPL-3.0-only", "13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7"),
    ("MPL-1.1", "557aed17f246818803a7e59ebc965e6771b9df3a92fb2f3598e38d288d65fe4c"),
    ("MPL-1.1", "a1f6fda22684e6ade96d65ece9aade670680bd18d25ecf99fb3c1a796e8fb2e8"),
    ("MPL-2.0", "2ae5d4417f09cff2e3412d0e35c4ee2439f6c18ca69d7d9cc799b33614c368a5"),
    ("MPL-2.0", "cc0f4adc32bdfbcb84da0472fa08c8a2f97aa7894272c14090e9297ed8e63445"),
]

# Titles that stand above a licence whose text has none.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "The BSD License", "BSD License"],
}

#: Words that open the part after a licence's terms, on how to use it.
APPENDIX = r"(?mi)^[^A-Za-z\n]*(?:appendix: how to apply|how to apply these terms|(?:addendum: )?how to use this license for)"

#: A line that opens so is no part of a licence's text, which may itself have lines that start with "copyright" or "(c)".
COPYRIGHT = (
    r"^[^\p{L}\p{N}©]*(copyright.*([0-9]{4}|\(c\)|©|\[yyyy\]|<year>)|\(c\).*([0-9]{4}|<year>)|©|all rights reserved)"
)


def canonical(text: Column) -> Column:
    """Lower case, words only, one spelling for each; lines of a copyright notice left out."""
    lines = F.filter(F.split(F.lower(text), "\n"), lambda line: ~line.rlike(COPYRIGHT))
    return canonical_line(F.array_join(lines, " "))


def canonical_line(lowered: Column) -> Column:
    """The same for lower-case text whose copyright lines are gone."""
    words = F.regexp_replace(F.regexp_replace(lowered, "&", " and "), r"[^\p{L}\p{N}]+", " ")
    words = F.trim(words)
    # A word is looked at only in texts that hold a variant at all.
    variants = r"\b(" + "|".join(SPELLINGS) + r")\b"
    pairs = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    one_spelling = F.array_join(F.transform(F.split(words, " "), lambda w: F.coalesce(F.try_element_at(pairs, w), w)), " ")
    return F.when(words.rlike(variants), one_spelling).otherwise(words)


def forms(text: str) -> list[str]:
    """A full licence text as it is found: whole, without its title, without its appendix, without both."""
    title = text.lstrip().split("\n\n", 1)
    bodies = [text, title[1]] if len(title) > 1 else [text]
    return [form for body in bodies for form in {body: None, re.split(APPENDIX, body, maxsplit=1)[0]: None}]


def titled(known: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Known texts, and each full one under the titles it may have."""
    under = [(name, f"{title}\n{text}") for name, text in known if len(text) > 500 for title in TITLES.get(name, [])]
    return known + under


def known_digests(
    spark: SparkSession, known: list[tuple[str, str]] = KNOWN, digests: list[tuple[str, str]] = DIGESTS
) -> DataFrame:
    """Digest and identifier of each known licence, from texts and from digests; a few hundred rows at most."""
    texts = spark.createDataFrame(titled(known), "license string, text string")
    of_texts = texts.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license")
    return of_texts.union(spark.createDataFrame(digests, "license string, digest string").select("digest", "license")).distinct()


def scan(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """Whole documents and whole lines whose canonical digest is known.

    Columns ``doc_id``, ``twin`` (a hash of the text, since ids may repeat),
    ``line`` (0: the whole document, else from 1) and ``license``. Null and
    empty texts, and lines without a word, match nothing. ``digests`` is the
    catalogue, so it is broadcast; it does not grow with the documents.
    """
    lowered = F.split(F.lower("text"), "\n")
    line_units = F.transform(
        lowered,
        lambda line, i: F.struct(
            (i + 1).alias("line"), F.when(~line.rlike(COPYRIGHT), canonical_line(line)).alias("words")
        ),
    )
    whole = F.array(F.struct(F.lit(0).alias("line"), canonical(F.col("text")).alias("words")))
    units = F.filter(F.concat(whole, line_units), lambda u: F.length(u["words"]) > 0)
    keyed = F.transform(units, lambda u: F.struct(u["line"].alias("line"), F.sha2(u["words"], 256).alias("digest")))
    return (
        docs.select("doc_id", F.xxhash64("text").alias("twin"), F.explode(keyed).alias("unit"))
        .select("doc_id", "twin", "unit.line", "unit.digest")
        .join(F.broadcast(digests), "digest")
        .select("doc_id", "twin", "line", "license")
    )


def licences(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """One row for each document: its own licence, those of its lines, and how many lines.

    ``document_license`` is null unless the whole text is a licence; on several
    identifiers for one digest the first in order counts.
    """
    found = (
        scan(docs, digests)
        .groupBy("doc_id", "twin")
        .agg(
            F.min(F.when(F.col("line") == 0, F.col("license"))).alias("document_license"),
            F.array_sort(F.collect_set(F.when(F.col("line") > 0, F.col("license")))).alias("found"),
            F.count_distinct(F.when(F.col("line") > 0, F.col("line"))).alias("lines"),
        )
    )
    keys = docs.select("doc_id", F.xxhash64("text").alias("twin"))
    same = keys["doc_id"].eqNullSafe(found["doc_id"]) & (keys["twin"] == found["twin"])
    return keys.join(found, same, "left").select(
        keys["doc_id"],
        "document_license",
        F.coalesce(F.array_join("found", ","), F.lit("")).alias("line_licenses"),
        F.coalesce("lines", F.lit(0)).cast("long").alias("n_license_lines"),
    )


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(documents(spark, sf_dir), known_digests(spark))


def _sql_canonical(lowered: str) -> str:
    return f"trim(regexp_replace(replace({lowered}, '&', ' and '), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def _sql_spelled(words: str) -> str:
    pairs = ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS.items())
    return (
        f"array_to_string(list_transform(string_split({words}, ' '), "
        f"lambda w: coalesce(map {{{pairs}}}[w], w)), ' ')"
    )


_SQL_COPYRIGHT = COPYRIGHT
_SQL_LINES = (
    "list_filter(string_split(lower(text), chr(10)), "
    f"lambda l: NOT regexp_matches(l, '{_SQL_COPYRIGHT}'))"
)
_SQL_WHOLE = _sql_spelled(_sql_canonical(f"array_to_string({_SQL_LINES}, ' ')"))
_VALUES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in titled(KNOWN))
_DIGEST_VALUES = ", ".join(f"('{name}', '{digest}')" for name, digest in DIGESTS)

OP8_SQL = f"""
WITH known AS (
  SELECT DISTINCT license, sha256({_SQL_WHOLE}) AS digest FROM (VALUES {_VALUES}) k(license, text)
  UNION
  SELECT license, digest FROM (VALUES {_DIGEST_VALUES}) k(license, digest)
), units AS (
  SELECT doc_id, 0 AS line, {_SQL_WHOLE} AS words FROM documents
  UNION ALL
  SELECT doc_id, line, {_sql_spelled(_sql_canonical("l"))} AS words
  FROM (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS l,
               generate_subscripts(string_split(lower(text), chr(10)), 1) AS line FROM documents)
  WHERE NOT regexp_matches(l, '{_SQL_COPYRIGHT}')
), hits AS (
  SELECT doc_id, line, license FROM units JOIN known ON sha256(words) = digest WHERE length(words) > 0
)
SELECT d.doc_id, min(license) FILTER (WHERE line = 0) AS document_license,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE line > 0), '') AS line_licenses,
       count(DISTINCT line) FILTER (WHERE line > 0) AS n_license_lines
FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id
"""
