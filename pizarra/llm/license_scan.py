"""Licence scan: Dice coefficient over word bigrams against licence templates.

Each line, each paragraph, each run of consecutive paragraphs and the whole text of a
document is a unit; the full licence texts are templates too.  A unit's words are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased; lines that begin with the word ``copyright`` are left out.  Of a unit with
``a`` distinct bigrams, only templates with a size between ``a * t / (2 - t)``
and ``a * (2 - t) / t`` can reach the threshold ``t``; the others are pruned.
"""

from __future__ import annotations

import re
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pizarra.llm.common import id_text, ship_code, slices
from pizarra.llm.hashing import NOT_ALNUM, gram_hashes, mix, span_hashes, word_spans

THRESHOLD = 0.8
UNITS = ("line", "paragraph", "text", "paragraphs")   # the last: a run of several

# The wording of the licences and of their usual notices.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_HEAD = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_GPL_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
    'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License."
)
_MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    'provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" '
    "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
    "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", f"{_MIT_HEAD} {_MIT_NOTICE} {_WARRANTY}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_NAMES} {_BSD_TAIL}"),
    ("ISC", _ISC),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MPL-2.0", _MPL_NOTICE),
    ("GPL-2.0", _GPL_NOTICE.format(2)),
    ("GPL-3.0", _GPL_NOTICE.format(3)),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]

_COPYRIGHT = span_hashes(np.frombuffer(b"copyright", np.uint8), np.array([0]), np.array([9]), True)[0]


def full_texts() -> list[tuple[str, str]]:
    """The full licence texts, without the lines that begin with ``copyright``.  Read on the driver,
    also from a zipped package; their absence is an error."""
    drop = re.compile(r"^[^a-z0-9\n]*copyright\b.*$", re.IGNORECASE | re.MULTILINE)
    files = sorted((f for f in (resources.files(__package__) / "licenses").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    if not files:
        raise FileNotFoundError("the licence texts are not in the package")
    return [(f.name.removesuffix(".txt"), drop.sub("", f.read_text(encoding="utf-8"))) for f in files]


def _words(data, off):
    s, e, first = word_spans(data, off, NOT_ALNUM)
    return span_hashes(data, s, e, lower=True), s, first


def template_bigrams(templates) -> list[tuple[str, np.ndarray]]:
    """Each template's name and sorted distinct bigrams; templates of one word have none."""
    out = []
    for name, text in templates:
        raw = np.frombuffer(text.encode(), np.uint8)
        words, _, _ = _words(raw, np.array([0, len(raw)]))
        out.append((name, np.unique(gram_hashes(words, 2))))
    return out


def _units(data, off):
    """Words kept, and for each kind of unit the unit number of each word."""
    words, s, first = _words(data, off)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    newline = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=newline[1:])
    line = newline[s]
    if not len(words):
        return words, row, {k: row for k in UNITS}
    other_row = np.append(True, row[1:] != row[:-1])
    new_line = other_row | np.append(True, line[1:] != line[:-1])
    new_par = other_row | np.append(True, line[1:] > line[:-1] + 1)
    line_no = np.cumsum(new_line) - 1
    keep = ~(words[new_line] == _COPYRIGHT)[line_no]
    numbers = {"line": line_no, "paragraph": np.cumsum(new_par) - 1, "text": row}
    return words[keep], row[keep], {k: v[keep] for k, v in numbers.items()}


def _best_run(grams, par, template, low: float) -> float:
    """Largest Dice of a run of paragraphs of one row with the template, 0 below the threshold.

    A run need not begin or end with a paragraph that adds nothing of the template to the rest of it: the run
    without it is as like.  So a run ends where a bigram of the template is met first, and begins
    with the last of one in the run."""
    n = len(template)
    need, cap, never = int(np.ceil(low * n - 1e-9)), n / low + 1e-9, len(par)
    par = np.cumsum(np.append(0, par[1:] != par[:-1]))
    starts = np.flatnonzero(np.append(True, par[1:] != par[:-1]))
    ends = np.append(starts[1:], len(par))
    at = np.minimum(np.searchsorted(template, grams), n - 1)
    hits = np.flatnonzero(template[at] == grams)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    before = np.full(len(grams), -1)                     # the same bigram's last place before
    before[order[1:][same]] = order[:-1][same]
    after, best = np.full(n, never), 0.0                 # each template bigram's first place from here on
    for part in np.split(hits, np.flatnonzero(np.diff(par[hits])) + 1)[::-1]:
        kinds, first = np.unique(at[part], return_index=True)
        later = after[kinds]
        after[kinds] = part[first]
        found = np.sort(after[after < never])
        if len(found) < need or not (later > found[need - 1]).any():
            continue
        p, size = int(par[part[0]]), 0
        s = done = int(starts[p])
        until = par[found + 1]                           # the paragraph that a run must reach to have it
        for q in np.unique(until[need - 1:]).tolist():
            e = int(ends[q]) - 1
            size += int((before[done:e] < s).sum())
            done = e
            if size > cap:
                break
            if q > p:
                best = max(best, 2 * int(np.searchsorted(until, q, side="right")) / (size + n))
    return best


def _runs(row, par, grams, templates, threshold: float):
    """Yields ``(row, name, dice, kind)`` of the best run of paragraphs for each template at the threshold."""
    low = threshold / (2 - threshold)
    sizes = np.array([len(b) for _, b in templates])
    every = np.concatenate([b for _, b in templates])
    order = np.argsort(every, kind="stable")
    known, start = np.unique(every[order], return_index=True)
    owner, start = np.repeat(np.arange(len(sizes)), sizes)[order], np.append(start, len(every))
    many = np.zeros(int(row[-1]) + 1, bool)
    many[row[1:][(row[1:] == row[:-1]) & (par[1:] != par[:-1])]] = True
    place = np.flatnonzero((row[1:] == row[:-1]) & many[row[1:]])
    at = np.minimum(np.searchsorted(known, grams[place]), len(known) - 1)
    hit = known[at] == grams[place]
    # a run has `low` of the template's bigrams, so the row has
    r, k = np.divmod(np.unique(row[place[hit]] * len(known) + at[hit]), len(known))
    number = np.diff(start)[k]
    pick = np.repeat(start[k] - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))
    shared = np.bincount(np.repeat(r, number) * len(sizes) + owner[pick], minlength=len(sizes)).astype(np.int64)
    for c in np.flatnonzero((shared > 0) & (shared >= low * np.resize(sizes, len(shared)) - 1e-9)).tolist():
        r, k = divmod(c, len(sizes))
        a, b = np.searchsorted(row, [r, r + 1])
        dice = _best_run(grams[a:b - 1], par[a:b], templates[k][1], low)
        if dice >= threshold:
            yield r, templates[k][0], dice, "paragraphs"


def matches(data, off, templates: list[tuple[str, np.ndarray]], threshold: float):
    """Yields ``(row, name, dice, kind)`` of every unit and template at the threshold; of the
    runs of paragraphs, the best for each template."""
    words, row, numbers = _units(data, off)
    if len(words) < 2:
        return
    grams = gram_hashes(words, 2)
    known = np.unique(np.concatenate([b for _, b in templates]))
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    hit = known[at] == grams
    sizes = np.array([len(b) for _, b in templates])
    low = threshold / (2 - threshold)
    yield from _runs(row, numbers["paragraph"], grams, templates, threshold)
    for kind in UNITS[:3]:
        unit = numbers[kind]
        inside = np.flatnonzero(unit[1:] == unit[:-1])
        if not len(inside):
            continue
        u = unit[inside]
        touched = np.zeros(int(u[-1]) + 1, bool)
        touched[u[hit[inside]]] = True
        inside, u = inside[touched[u]], u[touched[u]]
        with np.errstate(over="ignore"):
            _, one = np.unique(mix(grams[inside] ^ mix(u.astype(np.uint64))), return_index=True)
        inside, u = inside[one], u[one]
        size = np.bincount(u, minlength=len(touched))
        shared = np.bincount(u[hit[inside]], minlength=len(touched))
        # at the threshold, a unit shares `low` of its bigrams at least with a template
        live = np.flatnonzero((shared > 0) & (shared >= low * size - 1e-9) & (size >= low * sizes.min() - 1e-9) & (size <= sizes.max() / low + 1e-9))
        if not len(live):
            continue
        pick = np.isin(u, live)
        order = np.flatnonzero(pick)[np.argsort(u[pick], kind="stable")]
        for part in np.split(order, np.flatnonzero(np.diff(u[order])) + 1):
            a = grams[inside[part]]
            r = int(row[inside[part[0]]])
            for (name, b), n in zip(templates, sizes):
                if low * len(a) - 1e-9 <= n <= len(a) / low + 1e-9:
                    dice = 2 * np.isin(a, b).sum() / (len(a) + n)
                    if dice >= threshold:
                        yield r, name, float(dice), kind


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, license, dice, unit`` of its best match, the
    first by name and then by unit (line, paragraph, text, paragraphs) among equals; nulls where
    nothing reaches the threshold, as in null, empty and one-word texts.  The whole text
    is read, in one pass without a shuffle."""
    ship_code(docs.sparkSession)
    # a size bound for what goes to each task: the templates are a parameter list
    known = [(n, b) for n, b in template_bigrams(TEMPLATES + full_texts() if templates is None else templates) if len(b)]

    def scan(batches):
        for batch in batches:
            for rows, data, off in slices(batch, 1):
                best: dict[int, tuple] = {}
                for r, name, dice, kind in matches(data, off, known, threshold) if known else ():
                    key = (-dice, name, UNITS.index(kind))
                    if r not in best or key < best[r]:
                        best[r] = key
                found = [best.get(r) for r in range(rows.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([x and x[1] for x in found], pa.string()), pa.array([x and -x[0] for x in found], pa.float64()),
                     pa.array([x and UNITS[x[2]] for x in found], pa.string())], names=["doc_id", "license", "dice", "unit"])

    return id_text(docs, id_col, text_col).mapInArrow(scan, "doc_id long, license string, dice double, unit string")
