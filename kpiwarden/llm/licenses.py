"""Licence texts and notices in documents, by the Dice coefficient over sets of word bigrams.

With sizes a and b the coefficient is at most 2 min(a, b) / (a + b). So a template is
looked for only in a text that shares enough bigrams with it, and compared with lines,
paragraphs and the whole text if their sizes permit, and with runs of as many words as it
has: those that start with a bigram of the template and hold enough of them. Bigrams are
compared by 64-bit hashes. All of it happens within a row, in DataFrame functions, so
nothing is shuffled and the work of a row depends on its text only.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICE = 0.8

# Published licence texts (without titles and copyright lines) and usual notices.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of
the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT notice": "Released under the MIT License.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE.""",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under
the License.""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU General Public License for more details. You should have received a copy of the GNU General Public License
along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0 header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to
use this software for any purpose, including commercial applications, and to alter it and redistribute it freely,
subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not
claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such,
and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from
any source distribution.""",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0 notice": "Dedicated to the public domain under CC0 1.0.",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A licence with its bigrams, how many words it has, and the sizes that can reach the coefficient."""

    name: str
    bigrams: tuple[str, ...]
    words: int
    least: int
    most: int

    @staticmethod
    def of(name: str, text: str, dice: float) -> Template:
        lower = text.translate(str.maketrans(_UPPER, _LOWER))
        words = "".join(c if c.isascii() and c.isalnum() else " " for c in lower).split()
        bigrams = tuple(sorted({f"{a} {b}" for a, b in zip(words, words[1:])}))
        m, share = len(bigrams), Fraction(str(dice))
        return Template(name, bigrams, len(words), math.ceil(m * share / (2 - share)),
                        math.floor(m * (2 - share) / share))

    def hashes(self) -> Column:
        return F.array(*[F.xxhash64(*map(F.lit, b.split(" "))) for b in self.bigrams])


def _known(dice: float, templates: dict[str, str] | None) -> list[Template]:
    return [Template.of(name, text, dice) for name, text in (templates or TEMPLATES).items()]


def normalised(text: Column) -> Column:
    """Lower-case ASCII letters and digits; all else but line feeds is a space."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_replace(lower, "[^a-z0-9\n]+", " ")


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), 0)


def bigrams(text: Column) -> Column:
    """Hashes of a normalised text's word bigrams, in order."""
    words = F.filter(F.split(text, "[ \n]+"), lambda w: w != "")

    def paired(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        return F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b))

    return _once(words, paired)


def segments(text: Column) -> Column:
    """Sets of bigrams of a normalised text's lines, paragraphs and whole."""
    parts = F.concat(F.split(text, "\n"), F.split(text, r"\n[ \n]*\n"), F.array(text))
    return F.transform(F.array_distinct(parts), lambda p: F.array_distinct(bigrams(p)))


def _windows(listed: Column, template: Template) -> Column:
    """Sets of bigrams of the runs of a template's number of words that can reach the coefficient.

    A run starts with a bigram of the template; the least number of them has to fit in.
    """
    own, size = template.hashes(), template.words - 1
    starts = F.filter(F.sequence(F.lit(1), F.size(listed)), lambda i: F.array_contains(own, F.get(listed, i - 1)))
    return _once(
        starts,
        lambda s: F.transform(
            F.filter(s, lambda i, k: F.get(s, k + template.least - 1) - i < size),
            lambda i: F.array_distinct(F.slice(listed, i, size)),
        ),
    )


def _best(listed: Column, parts: Column, template: Template) -> Column:
    """The highest coefficient of a template with a segment or run; null if none can reach it."""
    own = template.hashes()
    of_size = F.filter(parts, lambda b: F.size(b).between(template.least, template.most))
    compared = F.concat(of_size, _windows(listed, template))
    return F.array_max(
        F.transform(
            compared,
            lambda b: 2.0 * F.size(F.array_intersect(b, own)) / (F.size(b) + len(template.bigrams)),
        )
    )


def license_matches(docs: DataFrame, text_col: str = "text", dice: float = DICE,
                    templates: dict[str, str] | None = None) -> Column:
    """``dice, license`` of every template that a text has, as an array column.

    A template's coefficient is the highest that it reaches with a line, a paragraph, the
    whole text, or a run of as many words as it has. Repeated bigrams count once on either
    side. A null or empty text has no matches.
    """
    known = _known(dice, templates)
    every = F.array_distinct(F.flatten(F.array(*[t.hashes() for t in known])))

    def found(text: Column, listed: Column, shared: Column) -> Column:
        possible = F.array(*[F.size(F.array_intersect(shared, t.hashes())) >= t.least for t in known])
        none = F.array().cast("array<struct<dice: double, license: string>>")

        def matches(ok: Column, parts: Column) -> Column:
            tried = F.array(*[
                F.when(F.get(ok, k), F.struct(_best(listed, parts, t).alias("dice"), F.lit(t.name).alias("license")))
                for k, t in enumerate(known)
            ])
            return F.filter(tried, lambda x: x["dice"] >= dice)

        return _once(possible, lambda ok: F.when(
            F.exists(ok, lambda x: x), _once(segments(text), lambda parts: matches(ok, parts))
        ).otherwise(none))

    return _once(normalised(F.col(text_col)), lambda text: _once(
        bigrams(text), lambda listed: _once(
            F.array_intersect(listed, every), lambda shared: found(text, listed, shared)
        )
    ))


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dice: float = DICE,
                   templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, license, dice, n_matches`` of every row: the best match (null if there is none), how many templates match.

    Of equally good templates the last in alphabetical order is named.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), license_matches(docs, text_col, dice, templates).alias("matches")
    )
    best = F.array_max("matches")
    return rows.select("doc_id", best["license"].alias("license"), best["dice"].alias("dice"),
                       F.size("matches").alias("n_matches"))


def oracle_sql(dice: float = DICE) -> str:
    """The rows of ``license_report`` over ``documents``."""
    values = ", ".join(
        f"({_quoted(t.name)}, [{', '.join(map(_quoted, t.bigrams))}], {t.words}, {t.least})"
        for t in _known(dice, None)
    )
    return rf"""
with templates(license, own, words, least) as (values {values}),
texts as (
  select row_number() over () as r, doc_id,
    regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^a-z0-9
]+', ' ', 'g') as t
  from documents),
parts as (
  select r, 'part' as kind, unnest(list_distinct(list_concat(
    list_concat(string_split(t, chr(10)), regexp_split_to_array(t, '
[ 
]*
')), [t]))) as p
  from texts
  union all select r, 'text', t from texts),
listed as (select r, kind, [w for w in regexp_split_to_array(p, '[ 
]+') if w <> ''] as ws from parts),
paired as (select r, kind, [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))] as bs from listed),
candidates as (
  select r, license, own, words, bs from paired join templates on len(list_intersect(bs, own)) >= least
  where kind = 'text'),
starts as (select r, license, own, words, bs, unnest(range(1, len(bs) + 1)) as i from candidates),
compared as (
  select r, license, own, list_distinct(bs[i:i + words - 2]) as bs from starts where list_contains(own, bs[i])
  union all
  select r, license, own, list_distinct(p.bs) from paired p join candidates c using (r) where kind = 'part'),
reached as (
  select r, license, max(2.0::double * len(list_intersect(bs, own)) / (len(bs) + len(own))) as dice
  from compared group by r, license),
best as (
  select r, max(struct_pack(dice := dice, license := license)) as b, count(*) as n
  from reached where dice >= {dice} group by r)
select doc_id, b.license as license, b.dice as dice, cast(coalesce(n, 0) as integer) as n_matches
from texts left join best using (r)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
