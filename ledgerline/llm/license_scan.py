"""License scan: Dice coefficient over word bigrams against templates, in DataFrame operations only.

A text is normalised (lower case, every run of other characters than ASCII letters and digits one space).  Its units
are the whole text and each of its lines.  A unit matches a template if the Dice coefficient of their sets of word
bigrams, 2 |A and B| / (|A| + |B|), is ``LEAST`` (0.8) or more.  For a template that none of these matches, units are
also all runs of consecutive words, over line ends, of ``SPANS`` times the template's bigrams; the best that matches
counts as one match.  So a text or header of several lines is found inside a longer document.

Pruning, all exact.  Size: the coefficient bounds |A| between LEAST / (2 - LEAST) and (2 - LEAST) / LEAST times |B|.
Content: a match shares at least LEAST / (2 - LEAST) of the template's bigrams, so it holds one of any set of
bigrams larger than the rest; a text that holds none of the template's chosen set is passed over before any unit
is built.  The chosen sets are the bigrams whose words are longest, as these are rarest.  Likewise it holds one of any
words that are in more bigrams than the rest; a text that holds none of the gate's few words is not even normalised.
Runs are built only around chosen bigrams, in texts that share as many bigrams with the template as a match must.

Edge cases: a null or empty text matches nothing (license null, dice 0).  Units of fewer than two words have no
bigram.  Equal coefficients go to the template first in ``TEMPLATES``, then to the first unit.  Texts of any length are
searched whole.  Repeated rows each give a row, an empty table none.  Extra columns are kept whatever their names; one
called as the result is replaced.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, own_name

LEAST = 0.8
#: Lengths of the runs of words compared, in the template's bigrams: a match has about 2/3 to 3/2 of them.
SPANS = (0.7, 0.85, 1.0, 1.2, 1.45)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution. """
_BSD3 = _BSD2 + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission. """
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
wrote the original software. If you use this software in a product, an acknowledgment in the product documentation
would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
more details. You should have received a copy of the GNU General Public License along with this program. If not, see
https://www.gnu.org/licenses/."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

_LGPL3 = """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General
Public License for more details. You should have received a copy of the GNU Lesser General Public License along with
this library. If not, see https://www.gnu.org/licenses/."""
_AGPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General
Public License for more details. You should have received a copy of the GNU Affero General Public License along with
this program. If not, see https://www.gnu.org/licenses/."""
_GPL2 = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
more details. You should have received a copy of the GNU General Public License along with this program; if not, write
to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""
_EPL2 = """This program and the accompanying materials are made available under the terms of the Eclipse Public License
2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""
_CC0 = """To the extent possible under law, the author has dedicated all copyright and related and neighboring rights
to this software to the public domain worldwide. This software is distributed without any warranty. You should have
received a copy of the CC0 Public Domain Dedication along with this software. If not, see
http://creativecommons.org/publicdomain/zero/1.0/."""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to
whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this
entire statement, including the above license grant, this restriction and the following disclaimer, must be included
in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or
derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""

#: (license, template), fixed values: full texts where they are short, else file headers, and one-line notices.
TEMPLATES = (
    ("MIT", _MIT),
    ("ISC", _ISC),
    ("BSD-2-Clause", _BSD2 + _BSD_TAIL),
    ("BSD-3-Clause", _BSD3 + _BSD_TAIL),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE),
    ("GPL-3.0", _GPL3),
    ("MPL-2.0", _MPL),
    ("Unlicense", _UNLICENSE),
    ("LGPL-3.0", _LGPL3),
    ("AGPL-3.0", _AGPL3),
    ("GPL-2.0", _GPL2),
    ("EPL-2.0", _EPL2),
    ("CC0-1.0", _CC0),
    ("BSL-1.0", _BOOST),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
)


def normal(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", re.sub(r"[A-Z]", lambda m: m[0].lower(), text)).strip(" ")


def bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a text, in order."""
    w = normal(text).split(" ")
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))


def chosen(grams: list[str], least: float) -> list[str]:
    """So many bigrams that a match holds one of them."""
    need = least / (2 - least) * len(grams)
    spare = int(len(grams) - need + 1e-9)
    return sorted(grams, key=lambda g: (-min(map(len, g.split())), -len(g), g))[: spare + 1]


#: Words that most English texts hold; the gate takes them only where others don't suffice.
COMMON = "a all and any are as at be but by for from have if in into is it may not of on or other that the this to under use was will with without you your".split()


def gate(sets: list[list[str]], least: float) -> list[str]:
    """Few words, rather long and rare ones, of which a match of any template holds one."""
    due = [int(len(g) - least / (2 - least) * len(g) + 1e-9) + 1 if g else 0 for g in sets]  # bigrams still to be covered
    holders: dict[str, list[set[str]]] = {}  # by word, the bigrams not yet covered that hold it, by template
    for i, g in enumerate(sets):
        for b in g:
            for w in b.split():
                holders.setdefault(w, [set() for _ in sets])[i].add(b)
    words, out = sorted(holders), []
    worth = {w: min(len(w), 8) + 2 if w not in COMMON else 1e-3 for w in words}
    while any(n > 0 for n in due):
        out.append(max(words, key=lambda w: sum(min(n, len(own)) for own, n in zip(holders[w], due, strict=True) if n > 0) * worth[w]))
        for i, hit in enumerate(map(set, holders[out[-1]])):
            due[i] -= len(hit)
            for w in {w for b in hit for w in b.split()}:
                holders[w][i] -= hit
    return out


def _normal(text: str) -> Column:
    ascii_low = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(ascii_low, r"[^a-z0-9]+", " ")


def scan(docs: DataFrame, into: str, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``docs`` with ``into``: array<struct<d, t, u>> of the matches of ``text``: coefficient, template, unit
    (0 the whole text, n its line n, -1 a run of words), best first."""
    norm, low_text, cand = (own_name(docs, f"{into}_{x}") for x in "nlc")
    sets = [bigrams(t) for _, t in templates]
    held = [F.when(F.greatest(*[F.col(norm).contains(f"{g}") for g in pick], F.lit(False)), F.lit(i)) if (pick := chosen(s, least)) else F.lit(None).cast("int") for i, s in enumerate(sets)]
    lists = ", ".join(f"split('{'|'.join(s)}', '[|]')" for s in sets)
    clean = lambda x: f"trim(BOTH ' ' FROM regexp_replace(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' '))"
    let = lambda name, value, body: f"transform(array({value}), {name} -> {body})[0]"
    low, high = min(map(len, sets)) * least / (2 - least), max(map(len, sets)) * (2 - least) / least
    grams = let("w", "split(x.n, ' ')", "array_distinct(transform(sequence(1, size(w) - 1), j -> concat(w[j - 1], ' ', w[j])))")
    lines = "transform(split(text, '\\n'), (x, j) -> struct(j + 1 as u, x as x))"
    units = f"filter(transform(concat(array(struct(0 as u, text as x)), {lines}), y -> struct(y.u as u, {clean('y.x')} as n)), x -> size(split(x.n, ' ')) - 1 >= {max(1, low - 1e-9)})"
    shared = f"size(array_intersect(x.g, array({lists})[t]))"
    bounds = f"size(x.g) between size(array({lists})[t]) * {least / (2 - least) - 1e-9} and size(array({lists})[t]) * {(2 - least) / least + 1e-9}"
    hits = f"transform(filter({cand}, t -> {bounds}), t -> struct(2.0D * {shared} / (size(x.g) + size(array({lists})[t])) as d, t as t, x.u as u))"
    every = f"flatten(transform(transform({units}, x -> struct(x.u as u, {grams} as g)), x -> {hits}))"
    order = "(a, b) -> case when a.d <> b.d then int(sign(b.d - a.d)) when a.t <> b.t then a.t - b.t else a.u - b.u end"
    none = "cast(array() as array<struct<d: double, t: int, u: int>>)"
    found = f"case when size({cand}) > 0 then array_sort(filter({every}, m -> m.d >= {least}), {order}) else {none} end"
    picks = ", ".join(f"split('{'|'.join(chosen(s, least))}', '[|]')" for s in sets)
    spans = ", ".join(f"array({', '.join(str(max(1, round(len(normal(t).split(' ')[1:]) * f))) for f in SPANS)})" for _, t in templates)
    sequel = let("w", f"split(trim(BOTH ' ' FROM {norm}), ' ')", "transform(sequence(1, size(w) - 1), j -> concat(w[j - 1], ' ', w[j]))")
    starts = "array_distinct(flatten(transform(at, p -> sequence(greatest(0, p - s + 1), p))))"
    dice = let("r", "array_distinct(slice(g, i + 1, s))", f"2.0D * size(array_intersect(r, array({lists})[t])) / (size(r) + size(array({lists})[t]))")
    best = let("at", f"filter(sequence(0, size(g) - 1), p -> array_contains(array({picks})[t], g[p]))", f"array_max(flatten(transform(array_distinct(array({spans})[t]), s -> transform({starts}, i -> {dice}))))")
    open_ = f"filter({cand}, t -> not exists({into}, m -> m.t = t) and size(array_intersect(g, array({lists})[t])) >= size(array({lists})[t]) * {least / (2 - least) - 1e-9})"
    runs = let("g", sequel, f"filter(transform({open_}, t -> struct({best} as d, t as t, -1 as u)), m -> m.d >= {least})")
    more = f"case when size({cand}) > 0 then array_sort(concat({into}, {runs}), {order}) else {none} end"
    holds = lambda w: F.col(low_text).contains(w) & (F.lit(True) if len(w) > 4 else F.col("text").rlike(f"(?i)(?<![a-z0-9]){w}(?![a-z0-9])"))
    passed = functools.reduce(lambda a, b: a | b, [holds(w) for w in gate(sets, least)], F.lit(False))
    # Other characters that lower() makes ASCII letters only let more texts pass.
    out = docs.withColumn(low_text, F.lower("text")).withColumn(norm, F.when(passed, _normal("text")).otherwise("")).drop(low_text)
    out = out.withColumn(cand, F.when(F.col(norm) != "", F.array_compact(F.array(*held))).otherwise(F.array().cast("array<int>")))
    return out.withColumn(into, F.expr(found)).withColumn(into, F.expr(more)).drop(norm, cand)


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """doc_id, license (the best match's, or null), dice (its coefficient, or 0), n_matches, licenses of every document."""
    names = F.array(*[F.lit(n) for n, _ in TEMPLATES])
    out = scan(documents(spark, sf_dir).select("doc_id", "text"), "found")
    best = F.get("found", F.lit(0))
    listed = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda m: F.get(names, m["t"])))), ",")
    return out.select("doc_id", F.get(names, best["t"]).alias("license"), F.coalesce(best["d"], F.lit(0.0)).alias("dice"), F.size("found").cast("long").alias("n_matches"), listed.alias("licenses"))
