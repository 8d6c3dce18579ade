r"""License scans by canonical digests: whole texts are normalised and hash-joined.

The canonical form of a text has no copyright lines, no letter case, no punctuation, one
spelling of equivalent words and single blanks. Its SHA-256 is looked up among the digests
of known licences, which are made by the same expression. Besides the whole text, each of
its lines is looked up as a text of its own, for one-line notices. DataFrame functions only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from importlib.resources import files
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import stored, text_or_empty

#: Spellings that mean the same, each with the one that is kept.
SPELLINGS = {
    "licence": "license",
    "sub license": "sublicense",
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "artefact": "artifact",
    "authorise": "authorize",
    "cancelled": "canceled",
    "colour": "color",
    "favour": "favor",
    "fulfil ": "fulfill ",
    "judgement": "judgment",
    "merchantibility": "merchantability",
    "non infringement": "noninfringement",
    "non commercial": "noncommercial",
    "organisation": "organization",
    "per cent": "percent",
    "utilis": "utiliz",
    "whilst": "while",
}
ACROSS = {other: kept for other, kept in SPELLINGS.items() if " " in other}
#: Lines that name a copyright holder and go. A line of a text's body that merely begins with the word,
#: as hard-wrapped texts have it, stays: after the word must come (c), a year, "by" or a capitalised name, and the
#: title-case terms of licence texts are no names.
YEAR = r"[\[<{(]?((19|20)[0-9][0-9]|yyyy|year)"
TERMS = (
    r"(?m)^([^\p{L}\p{N}\n]*)C(opyright[ \t]+(Holder|Owner|Notice|License|Licence|Law|Act|Treat|Statement|Right|Interest|"
    r"Status|Protection|Permission|Term|Grant|And|Or|In))"
)
COPYRIGHT = (
    r"(?im)^[^\p{L}\p{N}\n]*(copyright[ \t:,-]*(\(c\)|©|" + YEAR + r"|by[ \t])|(\(c\)|©)[ \t]*(copyright|" + YEAR + r")"
    r"|all rights reserved|(?-i:Copyright[ \t]+([Tt]he[ \t]+)?\p{Lu}))[^\n]*$"
)
END = "END OF TERMS AND CONDITIONS"
FSF = re.compile(r"51 Franklin St(reet)?,\s+Fifth\s+Floor,\s+Boston,?\s+MA\s+02110-1301,?\s+USA")
OTHER = r"[^\p{L}\p{N}\n]+"

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.\n\n"
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_SHORT: tuple[tuple[str, str], ...] = (
    (
        "MIT",
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n\n" + _WARRANTY + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies.\n\n" + _ISC_WARRANTY,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\n" + _ISC_WARRANTY,
    ),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_GRANT + _BSD_WARRANTY),
    (
        "BSD-3-Clause",
        "BSD 3-Clause License\n\n" + _BSD_GRANT + "3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.\n\n" + _BSD_WARRANTY,
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required.\n2. Altered source versions must be "
        "plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may "
        "not be removed or altered from any source distribution.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
)


def _forms(name: str, text: str, wordings: dict) -> Iterator[str]:
    """The usual forms of one text: other titles, no clause numbers, no appendix, older addresses."""
    titles = wordings["titles"].get(name, [])
    first, _, rest = text.partition("\n\n")
    body = rest if first in titles else text
    bodies = [body]
    if name.startswith("BSD"):
        bodies.append(re.sub(r"(?m)^\d\. ", "", body))
    if (end := body.find(END)) >= 0:
        bodies.append(body[: end + len(END)])
    bodies += [FSF.sub(other, b) for b in bodies if FSF.search(b) for other in wordings["addresses"]]
    bodies += [http for b in bodies if (http := b.replace("https://", "http://")) != b]
    yield text
    for b in bodies:
        yield from [f"{title}\n\n{b}" for title in titles] or [b]


def _notices(wordings: dict) -> Iterator[tuple[str, str]]:
    p = wordings["phrases"]
    heads = [" ".join(w).strip() for w in product(p["subject"], p["verb"], p["under"])] + [f"{label}:" for label in p["label"]]
    for name, spellings in wordings["names"].items():
        yield from ((name, f"{head} {spelling}.") for spelling in spellings for head in heads)


def _known() -> Iterator[tuple[str, str]]:
    """Texts and notices of this module and of the folder `known_licenses`, each wording once."""
    folder = files(__package__).joinpath("known_licenses")
    wordings = json.loads(folder.joinpath("wordings.json").read_text("utf-8"))
    stored_texts = sorted((f.name.removesuffix(".txt").split("@")[0], f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt"))
    texts = [(name, form) for name, text in [*_SHORT, *stored_texts] for form in _forms(name, text, wordings)]
    seen = set()
    for name, text in [*texts, *_notices(wordings)]:
        words = " ".join(re.findall(r"\w+", re.sub(r"(?m)^\W*copyright \(c\).*$", "", text.lower())))
        if words not in seen:
            seen.add(words)
            yield name, text


BROADCAST_BYTES = 16 << 20  # of digests and names

#: Known licence texts and one-line notices by SPDX name; callers may give their own.
KNOWN: tuple[tuple[str, str], ...] = tuple(_known())


def canonical_lines(text: Column) -> Column:
    """Canonical form of each line; lines with nothing left are gone."""
    unsigned = F.regexp_replace(F.regexp_replace(text, TERMS, "$1c$2"), COPYRIGHT, "")
    plain = F.regexp_replace(F.lower(unsigned), OTHER, " ")
    for other, kept in SPELLINGS.items():
        plain = F.replace(plain, F.lit(other), F.lit(kept))
    return F.filter(F.transform(F.split(plain, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def canonical_text(lines: Column) -> Column:
    """Canonical form of a whole text; spellings of several words may lie across its line breaks."""
    whole = F.array_join(lines, " ")
    for other, kept in ACROSS.items():
        whole = F.replace(whole, F.lit(other), F.lit(kept))
    return whole


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] | Mapping[str, str] = KNOWN) -> DataFrame:
    """(digest, license) of licence texts; of names with one digest the first stays."""
    rows = list(known.items()) if isinstance(known, Mapping) else list(known)
    texts = spark.createDataFrame(rows, "license string, text string")
    canonical = canonical_text(canonical_lines(F.col("text")))
    return texts.groupBy(digest(canonical).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, canonical_sha256, license and line_licenses of every row.

    `known` has (digest, license), of any size. It is stored once and measured: up to
    `broadcast_bytes` go to every task and no line is shuffled, beyond that lines and digests
    meet in a shuffle join, after the rows with their numbers have been stored. `license`
    is null where the whole text is no known licence; `line_licenses` lists the licences of
    single lines, sorted and comma-joined. A null text is empty, and an empty canonical text
    matches nothing. Repeated rows are answered each; an empty table gives no rows.
    """
    listed = stored(known.filter(F.col("digest") != F.sha2(F.lit(""), 256)).select("digest", "license"), "license-digests")
    size = listed.agg(F.coalesce(F.sum(F.length("digest") + F.length("license") + 32), F.lit(0)).alias("n")).first().n
    rows = docs.select(F.col(id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), canonical_lines(text_or_empty(text)).alias("lines"))
    if size <= broadcast_bytes:
        listed = F.broadcast(listed)
    else:
        rows = stored(rows, "license-lines")
    whole = canonical_text(F.col("lines"))
    single = F.transform(F.array_distinct("lines"), lambda line: F.struct(F.lit(False).alias("whole"), digest(line).alias("digest")))
    units = F.concat(F.array(F.struct(F.lit(True).alias("whole"), digest(whole).alias("digest"))), single)
    shown = rows.select("doc_id", "row", F.explode(units).alias("u")).select("doc_id", "row", "u.*")
    # only a text's own row and the lines that match are kept, so little is stored
    met = stored(shown.join(listed, "digest", "left").filter(F.col("whole") | F.col("license").isNotNull()), "licenses")
    lines = met.filter("not whole").groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses"))
    return met.filter("whole").join(lines, "row", "left").select(
        "doc_id", F.col("digest").alias("canonical_sha256"), "license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses")
    )


def license_scan(docs: DataFrame) -> DataFrame:
    return scan(docs, known_digests(docs.sparkSession))


def license_sql() -> str:
    """The same rows in SQL."""

    def canonical(text: str) -> str:
        unsigned = rf"regexp_replace(regexp_replace(coalesce({text}, ''), '{TERMS}', '\1c\2', 'g'), '{COPYRIGHT}', '', 'g')"
        plain = rf"regexp_replace(lower({unsigned}), '{OTHER}', ' ', 'g')"
        for other, kept in SPELLINGS.items():
            plain = f"replace({plain}, '{other}', '{kept}')"
        return f"[trim(l) for l in string_split({plain}, chr(10)) if trim(l) <> '']"

    def whole(lines: str) -> str:
        text = f"array_to_string({lines}, ' ')"
        for other, kept in ACROSS.items():
            text = f"replace({text}, '{other}', '{kept}')"
        return text

    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in KNOWN)
    return f"""
with known as (
    select sha256({whole(canonical("text"))}) as digest, min(license) as license
    from (values {values}) v(license, text) group by 1
),
docs as (select doc_id, {canonical("text")} as ls from documents),
lines as (
    select doc_id, string_agg(license, ',' order by license) as line_licenses
    from (select distinct doc_id, license from (select doc_id, unnest(ls) as line from docs) join known on sha256(line) = digest) group by doc_id
)
select doc_id, sha256({whole("ls")}) as canonical_sha256, license, coalesce(line_licenses, '') as line_licenses
from docs left join known on digest = sha256({whole("ls")}) left join lines using (doc_id)
"""
