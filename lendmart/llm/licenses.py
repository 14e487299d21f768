"""Licence scan: passages that agree with a licence template by the Dice coefficient over word bigrams.

Text and templates are normalised to lower-case words without punctuation.  A passage is a run of words that begins and ends with
bigrams of the template; with a match of at least ``DICE`` its length in bigrams lies between n * DICE / (2 - DICE) and n * (2 - DICE) / DICE
for a template of n bigrams, and it holds at least n * DICE / (2 - DICE) bigrams of the template.  These bounds prune
candidate templates and places by counting, before any coefficient is computed.  Of overlapping passages the best
stays, but one of a whole text goes before those of headers and notices that stand in it, and a header before a notice.  A whole
document that is a licence is one passage.

Templates are whole texts, standard headers, notices in usual wordings, and SPDX lines.  In short wordings most words are the same for
all licences, so a notice may have a core, the words that tell the licence: a passage must hold all bigrams of it.

The index of template bigrams is small and fixed by the templates; the text is read once and nothing is shuffled.

Defined cases: a null, empty or one-word text has no passage; a very long text is scanned whole; repeated rows are scanned alike; ties go to the longer template, then to the
name, then to the earlier passage; an empty table gives an empty result; other columns of the input, whatever their names, take no part.
"""

from __future__ import annotations

import itertools
import pkgutil
from bisect import bisect
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DICE = 0.8

# Names of licences as notices give them, and the words notices begin with.
NAMES = {
    "Apache-2.0": "the Apache License, Version 2.0",
    "MIT": "the MIT License",
    "GPL-2.0": "the GNU General Public License, version 2",
    "GPL-3.0": "the GNU General Public License, version 3",
    "LGPL-2.1": "the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "the GNU Affero General Public License, version 3",
    "MPL-2.0": "the Mozilla Public License, Version 2.0",
    "BSD-2-Clause": "the BSD 2-Clause License",
    "BSD-3-Clause": "the BSD 3-Clause License",
    "ISC": "the ISC License",
    "CC0-1.0": "CC0 1.0",
    "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-ND-4.0": "CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0",
}
OPENINGS = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This software is licensed under")
BSD_FIRST = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_LAST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# Licences short enough to stand in a document as a whole.
WHOLE = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "BSD-2-Clause": f"{BSD_FIRST} {BSD_LAST}",
    "BSD-3-Clause": f"""{BSD_FIRST} 3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission. {BSD_LAST}""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source
versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be
removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate
any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large
and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
# Whole texts that stand in files of their own.
FILES = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC0-1.0")
# Other names of the licences in notices; each is a core.
CC = {"CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-NC-4.0": "Attribution-NonCommercial",
      "CC-BY-ND-4.0": "Attribution-NoDerivatives", "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike"}
GNU = {"GPL-2.0": ("GNU General Public License", "GPL", "2"), "GPL-3.0": ("GNU General Public License", "GPL", "3"),
       "LGPL-2.1": ("GNU Lesser General Public License", "LGPL", "2.1"), "LGPL-3.0": ("GNU Lesser General Public License", "LGPL", "3"),
       "AGPL-3.0": ("GNU Affero General Public License", "AGPL", "3")}
ALIASES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache License v2", "Apache Software License 2.0",
                   "Apache Software License, Version 2.0", "Apache 2.0 License", "Apache 2.0", "Apache 2 License"),
    "MIT": ("MIT License", "MIT Licence", "Expat License"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0", "Mozilla Public License, v. 2.0",
                "MPL 2.0", "MPL v2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "BSD 2-Clause", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "BSD 3-Clause", "New BSD License", "Modified BSD License", "Revised BSD License"),
    "ISC": ("ISC License", "ISC Licence"),
    "Zlib": ("zlib License", "zlib/libpng License"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero 1.0", "Creative Commons Zero v1.0 Universal"),
} | {
    key: tuple(f"{name} {v}" for name in (full, full.removeprefix("GNU "), f"GNU {short}", short) for v in (f"version {n}", f"v{n}", n))
    + tuple(f"{name} {v}" for name in (full, f"GNU {short}", short) for v in (f"v{n}.0", f"version {n}.0", f"{n}.0") if "." not in n)
    + ((f"{short}v{n}", f"GNU {short}v{n}")) for key, (full, short, n) in GNU.items()
} | {
    key: (f"Creative Commons {words} 4.0 International License", f"Creative Commons {words} 4.0 International", f"Creative Commons {words} 4.0",
          f"Creative Commons {key[3:-4]} 4.0", key.replace("-", " ")) for key, words in CC.items()
}
VERBS = ("licensed", "released", "distributed", "available", "published", "provided", "shared")
ARTICLES = ("", "the", "a", "the terms of the")
# Names so telling that they need no words before them, as in the titles of the licences.
TITLES = {key: (f"Creative Commons {words} 4.0 International", f"Creative Commons {words} 4.0 International Public License")
          for key, words in CC.items()} | {"CC0-1.0": ("CC0 1.0 Universal",)}
# Identifiers after SPDX-License-Identifier that begin like one of the others but are not that licence.
SPDX_LONGER = ("MIT-0", "MIT-CMU", "MIT-feh", "BSD-2-Clause-Patent", "BSD-2-Clause-Views", "BSD-3-Clause-Clear", "BSD-3-Clause-LBNL",
               "BSD-3-Clause-Attribution", "BSD-3-Clause-Modification", "zlib-acknowledgement", "MPL-2.0-no-copyleft-exception")
LONG, HEADER = 1000, 25  # bigrams of a whole long text, and of a header or a short whole text

# Letters and digits stay, A-Z become small, other ASCII characters part words; bytes of other characters stay.
PARTING = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def headers() -> list[tuple[str, str, tuple[str, ...]]]:
    """Name, text and core of the standard headers of source files."""
    out = []
    for key, (full, _, n) in GNU.items():
        core = (f"{full} as published by the Free Software Foundation", f"version {n} of the license")
        for what in ("program", "library") if key.startswith("LGPL") else ("program",):
            for later in (", or (at your option) any later version", ""):
                first = (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the {full} as published by "
                         f"the Free Software Foundation, either version {n} of the License{later}.")
                rest = (f" This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                        f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {full} for more details. You should have "
                        f"received a copy of the {full} along with this {what}.")
                out += [(key, first, core), (key, f"{first}{rest} If not, see https://www.gnu.org/licenses/.", core),
                        (key, f"under the terms of the {full} as published by the Free Software Foundation; either version {n} of the License{later}", core)]
        for v in (f"version {n} as published by the Free Software Foundation", f"as published by the Free Software Foundation, version {n}",
                  f"as published by the Free Software Foundation; version {n}", f"version {n} only, as published by the Free Software Foundation"):
            out.append((key, f"under the terms of the {full} {v}", (f"{full}", f"version {n}")))
    out.append(("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
                ("Apache License, Version 2.0",)))
    out.append(("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""", ("Mozilla Public License, v. 2.0",)))
    for key, words in CC.items():
        name = f"Creative Commons {words} 4.0 International"
        out.append((key, f"This work is licensed under a {name} License. To view a copy of this license, visit "
                         f"http://creativecommons.org/licenses/{key[3:-4].lower()}/4.0/", (name,)))
    return out


def notices() -> list[tuple[str, str, tuple[str, ...]]]:
    """Name, text and core of usual notices, and of SPDX lines, of which the core is all."""
    openings = [f"{v} under {a}".strip() for v in VERBS for a in ARTICLES] + ["subject to the terms of the"]
    # A name of one word has no bigram; with the word before it, it has.
    out = [(name, f"{o} {words}", (words if len(words_of(words)) > 1 else f"{o.split()[-1]} {words}",))
           for name, known in ALIASES.items() for words in known for o in openings]
    out += [(name, words, (words,)) for name, known in TITLES.items() for words in known]
    for name in (*NAMES, "Zlib", "Unlicense", *SPDX_LONGER):
        ends = ("", "-only", "-or-later", "+") if name in GNU else ("",)
        out += [(name, line, (line,)) for line in (f"SPDX-License-Identifier: {name}{end}" for end in ends)]
    return out


def templates() -> list[tuple]:
    """Name and text of every template, and its core if it has one."""
    files = [(name, pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()) for name in FILES]
    return [(name, f"{o} {words}") for name, words in NAMES.items() for o in OPENINGS] + list(WHOLE.items()) + files + headers() + notices()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(PARTING).split()


def bigrams_of(text: str) -> list[tuple[bytes, bytes]]:
    words = words_of(text)
    return list(zip(words, words[1:]))


class Templates:
    """The templates ``(name, text)`` or ``(name, text, core)`` with an index from bigrams to the templates that hold them."""

    def __init__(self, texts: list[tuple], dice: float = DICE):
        # Equal texts count once.
        texts = list({(t[0], tuple(words_of(t[1]))): t for t in texts}.values())
        self.dice, self.names = dice, [t[0] for t in texts]
        grams = [bigrams_of(t[1]) for t in texts]
        self.bigrams = [Counter(g) for g in grams]
        self.sizes = [len(g) for g in grams]
        self.numbers: dict[tuple[bytes, bytes], int] = {}
        for g in itertools.chain.from_iterable(grams):
            self.numbers.setdefault(g, len(self.numbers))
        # Of each template the numbers of its bigrams in order, how often each stands in it, and the core's places among them.
        self.own, self.often, self.core = [], [], []
        for t, count in zip(texts, self.bigrams):
            numbers, often = zip(*sorted((self.numbers[g], c) for g, c in count.items())) if count else ((), ())
            core = {self.numbers[g] for c in t[2:] for part in c for g in bigrams_of(part)}
            self.own.append(np.array(numbers, np.int64))
            self.often.append(np.array(often, np.int64))
            self.core.append(np.searchsorted(self.own[-1], sorted(core)))
        # A template with a core is looked for where the rarest bigram of the core is, another one by all its bigrams.
        held = Counter(g for own in self.own for g in own.tolist())
        index: list[list[tuple[int, int]]] = [[] for _ in self.numbers]
        for k, (own, often, core) in enumerate(zip(self.own, self.often, self.core)):
            if len(core):
                index[min(own[core].tolist(), key=lambda g: (held[g], g))].append((k, self.sizes[k]))
            else:
                for g, c in zip(own.tolist(), often.tolist()):
                    index[g].append((k, c))
        self.first = np.cumsum([0, *map(len, index)])
        entries = list(itertools.chain.from_iterable(index))
        self.listed, self.most = (np.array(x, np.int64) for x in (zip(*entries) if entries else ((), ())))
        self.cored = np.array([len(c) > 0 for c in self.core], bool)
        self.least = np.array([max(1, int(np.ceil(n * dice / (2 - dice) - 1e-9))) for n in self.sizes], np.int64)

    def scan(self, text: str | None) -> list[dict]:
        """The best passages that do not overlap: licence, coefficient, first word and number of words."""
        words = words_of(text)
        numbers = np.fromiter(map(self.numbers.get, zip(words, words[1:]), itertools.repeat(-1)), np.int64, max(0, len(words) - 1))
        places = np.flatnonzero(numbers >= 0)
        if not len(places):
            return []
        numbers = numbers[places]
        passages = [p for k in self.candidates(numbers) for p in self.passages(k, places, numbers)]
        tier = lambda k: (self.sizes[k] < LONG) + (self.sizes[k] < HEADER)
        passages.sort(key=lambda p: (tier(p[1]), -p[0], -self.sizes[p[1]], self.names[p[1]], p[2]))
        # Those kept so far, by place: first and last bigram, coefficient, template.
        kept: list[tuple[int, int, float, int]] = []
        for d, k, a, b in passages:
            at = bisect(kept, (b, len(words)))
            if not at or kept[at - 1][1] < a:
                kept.insert(at, (a, b, d, k))
        return [{"license": self.names[k], "dice": d, "first_word": a, "n_words": b - a + 2} for a, b, d, k in kept]

    def candidates(self, numbers: np.ndarray) -> list[int]:
        """The templates of which the text holds the core, or else enough bigrams."""
        present, counts = np.unique(numbers, return_counts=True)
        begin, many = self.first[present], self.first[present + 1] - self.first[present]
        at = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
        k = self.listed[at]
        shared = np.bincount(k, np.minimum(self.most[at], np.repeat(counts, many)), len(self.names))
        some = np.flatnonzero(shared >= np.where(self.cored, 1, self.least))
        return [k for k in some.tolist() if not self.cored[k] or np.isin(self.own[k][self.core[k]], present).all()]

    def passages(self, k: int, places: np.ndarray, numbers: np.ndarray) -> list[tuple[float, int, int, int]]:
        """For each place where one may begin, the best passage for template ``k``: coefficient, template, first and last bigram."""
        n, own, often, core = self.sizes[k], self.own[k], self.often[k], self.core[k]
        least, longest = int(self.least[k]), int(n * (2 - self.dice) / self.dice + 1e-9)
        slots = np.searchsorted(own, numbers)
        slots[slots == len(own)] = 0
        mine = own[slots] == numbers
        at, slots = places[mine], slots[mine]
        if len(at) < least:
            return []
        # The least number of the template's bigrams must follow within the greatest length.
        begins = np.flatnonzero(at[least - 1:] - at[:len(at) - least + 1] < longest)
        if not len(begins):
            return []
        # A bigram counts if the passage begins behind the place from which on the template's number of them is used up.
        order = np.argsort(slots, kind="stable")
        sorted_slots, back = slots[order], np.arange(len(order)) - often[slots[order]]
        full = np.full(len(at), -1)
        same = (back >= 0) & (sorted_slots[back] == sorted_slots)
        full[order[same]] = order[back[same]]
        of_core = [np.flatnonzero(slots == c) for c in core]
        out = []
        for s, stop in zip(begins.tolist(), np.searchsorted(at, at[begins] + longest).tolist()):
            value = 2 * np.cumsum(full[s:stop] < s) / (at[s:stop] - at[s] + 1 + n)
            skipped = 0
            for c in of_core:
                i = int(np.searchsorted(c, s))
                skipped = max(skipped, int(c[i]) - s if i < len(c) else stop)
            if skipped >= stop - s:
                continue
            e = skipped + int(value[skipped:].argmax())
            if value[e] >= self.dice:
                out.append((float(value[e]), k, int(at[s]), int(at[s + e])))
        return out


def scan_documents(docs: DataFrame, texts: list[tuple] | None = None, dice: float = DICE) -> DataFrame:
    """``doc_id, license, dice, first_word, n_words`` of every passage; words count from 0 in the normalised text."""
    known = Templates(texts or templates(), dice)

    @F.pandas_udf("array<struct<license:string,dice:double,first_word:int,n_words:int>>")
    def scan(column: pd.Series) -> pd.Series:
        return pd.Series([known.scan(t) for t in column])

    return docs.select("doc_id", F.explode(scan(F.col("text"))).alias("p")).select("doc_id", "p.*")
