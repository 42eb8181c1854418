"""Licence texts and notices in documents, by the Dice coefficient over word bigrams."""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DICE = 0.85
_TOKEN = re.compile(r"[a-z0-9]+")

# Published licence texts and notices (placeholders for names and years left out).
_TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS
PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire
statement, including the above license grant, this restriction and the following disclaimer, must be included in all
copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR
ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program; if not, write to the
Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General
Public License for more details. You should have received a copy of the GNU Affero General Public License along with this
program.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General
Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this
library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means.""",
}
# Identifier, name in a sentence, versions.
_NAMES = (
    ("MIT", "MIT License", ()),
    ("ISC", "ISC License", ()),
    ("BSD", "BSD License", ()),
    ("Apache", "Apache License", ("2.0",)),
    ("GPL", "GNU General Public License", ("2", "3")),
    ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
    ("AGPL", "GNU Affero General Public License", ("3",)),
    ("MPL", "Mozilla Public License", ("2.0",)),
)
_CREATIVE_COMMONS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
_OPENINGS = ("Released under the {}.", "Licensed under the {}.", "This work is licensed under the {}.", "Distributed under the {}.")


def shipped_templates() -> list[tuple[str, str]]:
    """(licence, text) of the full texts and of one-line statements, made of the openings, names and versions above."""
    out = list(_TEXTS.items())
    for opening in _OPENINGS:
        for short, name, versions in _NAMES:
            out.append((short, opening.format(name)))
            out += [(f"{short}-{v}", opening.format(f"{name}, Version {v}")) for v in versions]
        for terms in _CREATIVE_COMMONS:
            out += [(f"CC-{terms}-{v}", opening.replace("the ", "").format(f"CC {terms} {v}")) for v in ("3.0", "4.0")]
    return out


def bigrams(text: str) -> Counter:
    """The multiset of pairs of neighbouring words of the normalised text: lower case, letters and digits only."""
    tokens = _TOKEN.findall(text.lower())
    return Counter(zip(tokens, tokens[1:], strict=False))


class Templates:
    """Templates by size, with an index from bigrams to templates.

    Dice >= d needs a size between d / (2 - d) and (2 - d) / d times the template's; templates out of these bounds are
    not compared. Neither are those without a common bigram, whose Dice is 0.
    """

    def __init__(self, templates: list[tuple[str, str]], dice: float):
        self.dice = dice
        counted = [(name, bigrams(text)) for name, text in templates]
        counted = sorted(((sum(c.values()), name, c) for name, c in counted if c), key=lambda x: x[:2])
        self.sizes = [size for size, _, _ in counted]
        self.names = [name for _, name, _ in counted]
        self.grams = [grams for _, _, grams in counted]
        self.holders: dict[tuple[str, str], list[int]] = {}
        for i, grams in enumerate(self.grams):
            for gram in grams:
                self.holders.setdefault(gram, []).append(i)

    def best(self, tokens: list[str]) -> tuple[float, str] | None:
        """The largest coefficient of at least ``dice`` and its licence; the first by size and name among equals."""
        size = len(tokens) - 1
        first = bisect_left(self.sizes, size * self.dice / (2 - self.dice) - 1e-9)
        last = bisect_right(self.sizes, size * (2 - self.dice) / self.dice + 1e-9)
        if size < 1 or first >= last:
            return None
        near = {i for gram in zip(tokens, tokens[1:], strict=False) for i in self.holders.get(gram, ()) if first <= i < last}
        if not near:
            return None
        own = Counter(zip(tokens, tokens[1:], strict=False))
        top = max((2 * sum((own & self.grams[i]).values()) / (size + self.sizes[i]), -i) for i in near)
        return (top[0], self.names[-top[1]]) if top[0] >= self.dice else None

    def _best_ends(self, i: int, places: list[int], grams: list[tuple[str, str]], first: int, until: int) -> tuple[float, int, int] | None:
        """(coefficient, bigrams, last place) of template ``i``'s best window that begins at ``places[first]``, within ``places[:until]``."""
        size, wanted = self.sizes[i], self.grams[i]
        widest = int(size * (2 - self.dice) / self.dice + 1e-9)
        if first >= until:
            return None
        begin = places[first]
        held: dict[tuple[str, str], int] = {}
        common, best = 0, None
        for at in range(first, until):
            width = places[at] - begin + 1
            if width > widest:
                break
            gram = grams[places[at]]
            held[gram] = held.get(gram, 0) + 1
            if held[gram] <= wanted[gram]:
                common += 1
                found = (2 * common / (width + size), width, places[at])
                if found[0] >= self.dice and (best is None or found[:2] > best[:2]):
                    best = found
        return best

    def _starts(self, i: int, places: list[int], grams: list[tuple[str, str]]) -> list[int]:
        """Indices of the places from which the widest window has as many bigrams of the template as any match needs."""
        size, wanted = self.sizes[i], self.grams[i]
        need = size * self.dice / (2 - self.dice) - 1e-9
        if len(places) < need:
            return []
        widest = int(size * (2 - self.dice) / self.dice + 1e-9)
        held: dict[tuple[str, str], int] = {}
        common = end = 0
        out = []
        for first, begin in enumerate(places):
            while end < len(places) and places[end] - begin < widest:
                gram = grams[places[end]]
                held[gram] = held.get(gram, 0) + 1
                common += held[gram] <= wanted[gram]
                end += 1
            if common >= need:
                out.append(first)
            gram = grams[begin]
            common -= held[gram] <= wanted[gram]
            held[gram] -= 1
        return out

    def windows(self, tokens: list[str]) -> list[tuple[float, str, int, int]]:
        """(coefficient, licence, first word, last word) of the passages among all windows of neighbouring words.

        Windows with a coefficient of at least ``dice`` are taken best first: by coefficient, then more words, then
        the earlier, then the template's size and name. A window that shares a word with a taken one is none.

        A best window begins and ends with a bigram of its template, so only such are tried, from places where a
        multiset count, slid over the text, reaches what the bounds ask for.
        """
        grams = list(zip(tokens, tokens[1:], strict=False))
        found: dict[int, list[int]] = {}
        for at, gram in enumerate(grams):
            for i in self.holders.get(gram, ()):
                found.setdefault(i, []).append(at)
        queue = []
        for i, places in found.items():
            for first in self._starts(i, places, grams):
                best = self._best_ends(i, places, grams, first, len(places))
                if best:
                    queue.append((-best[0], -best[1], places[first], i, first, best[2]))
        heapq.heapify(queue)
        starts: list[int] = []  # of the taken windows, in order, with the words after their ends
        ends: list[int] = []
        out = []
        while queue:
            score, _, begin, i, first, last = heapq.heappop(queue)
            slot = bisect_right(starts, begin)
            if slot and ends[slot - 1] > begin:
                continue
            if slot < len(starts) and starts[slot] < last + 2:
                # What is left before the taken window may still hold a smaller one.
                best = self._best_ends(i, found[i], grams, first, bisect_left(found[i], starts[slot] - 1))
                if best:
                    heapq.heappush(queue, (-best[0], -best[1], begin, i, first, best[2]))
                continue
            starts.insert(slot, begin)
            ends.insert(slot, last + 2)
            out.append((-score, self.names[i], begin, last + 1))
        return sorted(out, key=lambda x: x[2])


def scan_licenses(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: list[tuple[str, str]] | None = None, dice: float = DICE
) -> DataFrame:
    """Licences that documents state: (doc_id, license, dice, first_line, last_line), a row per document and licence.

    All windows of words, across line and paragraph breaks, are compared with the templates; of those that share words
    the one with the largest coefficient counts, if that is at least ``dice`` (see ``Templates.windows``). Of a licence
    found repeatedly the first place with the largest coefficient is told. Lines count from 0.

    Defined cases: NULL, empty and wordless texts, and single words, have no licence and give no row. Repeated rows
    give a row each; a NULL doc_id stays NULL. Extra columns are ignored.
    """
    known = Templates(shipped_templates() if templates is None else templates, dice)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for name, missing, body in zip(part["doc_id"], part["missing"], part["text"], strict=True):
                found: dict[str, tuple[float, int, int]] = {}
                lower = (body or "").lower()
                hits = known.windows(_TOKEN.findall(lower))
                lines = [n for n, line in enumerate(lower.split("\n")) for _ in _TOKEN.findall(line)] if hits else []
                for score, license, first, last in hits:
                    if score > found.get(license, (0,))[0]:
                        found[license] = (score, lines[first], lines[last])
                out += [(None if missing else name, license, *place) for license, place in sorted(found.items())]
            table = pd.DataFrame(out, columns=["doc_id", "license", "dice", "first_line", "last_line"])
            yield table.astype({"doc_id": "Int64", "first_line": "int64", "last_line": "int64", "dice": "float64"})

    number = F.col(doc_id).cast("long")
    source = docs.select(F.coalesce(number, F.lit(0).cast("long")).alias("doc_id"), number.isNull().alias("missing"), F.col(text).alias("text"))
    return source.mapInPandas(run, "doc_id long, license string, dice double, first_line long, last_line long")
