"""License scan: a trained paragraph classifier whose findings are confirmed by the notices' wording.

A paragraph is a line with a word, together with the lines that it is wrapped over: a line of `WRAPPED`
characters that ends without a full stop or the like goes on in the next one. Its features are counts of the words and word pairs of the known
notices, scaled by the square root of their number; a multinomial logistic regression over them gives
the families and `none`. Two things make a finding `unknown` instead of a family: a probability below
the calibrated cut, and wording too far from every notice of the predicted family. Wording is compared
by word pairs, and a pair that notices of several families have says the less about any of them. Lines
of a few words ("License: MIT") have too few pairs for that; their words are compared with the families' names.

Training is numpy on the driver, over the notices below, seeded variants of them, plain sentences with
the same words, and a bounded sample of `LINES` corpus lines without licence vocabulary (one line a
document, its first `LONGEST` characters, the documents by a hash of their id, one row for an id). The
cut is the one that best tells held-out variants of known notices from notices of families that are not
listed, and so is the likeness from which a finding is confirmed. What is no notice at all is calibrated
too: the probability of `none`
and the likeness to any notice that best tell unlisted notices from held-out corpus lines. Scanning covers every line of every text, in Arrow batches, without a
shuffle.

Defined cases: null and empty texts have no paragraph and no licence; a paragraph
without a letter is no notice; several licences are all listed, the most frequent (then first by name) is the document's; repeated rows each give a row; an empty
table gives an empty result and is trained on notices and plain sentences alone; other columns pass
through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundweave.operators.ordering import top_k

from .common import class_sample, col, fresh, ship

# Wordings of public licence notices, by family.
NOTICES: dict[str, tuple[str, ...]] = {
    "agpl": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Affero General Public License along with this program. "
        "If not, see <https://www.gnu.org/licenses/>.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied.",
        "This project is released under the Apache 2.0 license.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE "
        "file.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
        "and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
        "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
        "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "cc0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to "
        "this work.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
        "Released under the GNU GPL v3.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, "
        "see <https://www.gnu.org/licenses/>.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    "reserved": (
        "All rights reserved.",
        "Copyright holders reserve all rights; reproduction without written permission is prohibited.",
    ),
}
# Names and SPDX identifiers, as they stand in short notices.
NAMES: dict[str, tuple[str, ...]] = {
    "agpl": ("AGPL", "AGPLv3", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "GNU AGPL", "GNU AGPL v3", "GNU AGPLv3"),
    "apache-2.0": ("Apache 2.0", "Apache-2.0", "Apache License 2.0", "Apache License, Version 2.0", "Apache License v2.0"),
    "bsd": ("BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD 2-Clause", "BSD 3-Clause", "New BSD", "Simplified BSD"),
    "cc-by": ("CC BY", "CC-BY", "CC BY 4.0", "CC BY 3.0", "CC-BY-4.0", "CC-BY-3.0"),
    "cc-by-nc": ("CC BY-NC", "CC-BY-NC", "CC BY-NC 4.0", "CC BY-NC 3.0", "CC-BY-NC-4.0", "CC-BY-NC-3.0"),
    "cc-by-sa": ("CC BY-SA", "CC-BY-SA", "CC BY-SA 4.0", "CC BY-SA 3.0", "CC-BY-SA-4.0", "CC-BY-SA-3.0"),
    "cc0": ("CC0", "CC0 1.0", "CC0-1.0", "CC0 1.0 Universal"),
    "gpl": (
        "GPL", "GPLv2", "GPLv3", "GPL v2", "GPL v3", "GPL-2.0", "GPL-3.0", "GPL-2.0-only", "GPL-3.0-only",
        "GPL-2.0-or-later", "GPL-3.0-or-later", "GNU GPL", "GNU GPL v2", "GNU GPL v3", "GNU GPLv3",
        "GNU General Public License", "GNU General Public License v3.0",
    ),
    "lgpl": (
        "LGPL", "LGPLv2.1", "LGPLv3", "LGPL v2.1", "LGPL v3", "LGPL-2.1", "LGPL-3.0", "LGPL-2.1-only",
        "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "GNU LGPL", "GNU LGPL v3",
    ),
    "mit": ("MIT", "Expat", "MIT/Expat"),
    "mpl-2.0": ("MPL 2.0", "MPL-2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"),
}
FORMS = ("{} License", "The {} License", "License: {}", "Licensed under {}", "SPDX-License-Identifier: {}")
# Notices of families that are not listed, and plain sentences with the same words.
OTHERS = (
    "Licensed under the Harbour Community License, edition 7.",
    "Distributed under the Open Meadow Public Licence.",
    "This text is released under the terms of the Wanderer Sharing Agreement.",
    "Covered by the Eastgate Research License, version 9.",
    "This work is licensed under house terms; ask the editor.",
    "Use is permitted under the Blue Kettle End User Agreement.",
    "ISC License",
    "License: Zlib",
    "SPDX-License-Identifier: EUPL-1.2",
    "The Harbour License",
    "Licensed under Artistic-2.0",
    "Licensed under the Orchard Public License, version 2.0.",
    "This work is licensed under the Tidewater General License, version 3.",
    "Released under the Brook Software License.",
    "You should have received a copy of the Northgate Source License along with this program.",
)
PLAIN = (
    "The driver had to renew a license before the end of the year.",
    "Version 3 of the plan was free for any person in the public library.",
    "She asked for permission to use the work of the foundation.",
    "The software was released in spring and the public liked it.",
    "All rights and duties of the members are in the following conditions.",
    "A copy of the file was made without a word about the terms.",
    "He works at the institute as published in the general notice.",
    "The commons are open to the public and free of charge.",
    "Version 3.0",
    "Version 2.",
    "2.0",
    "The public office",
    "Read by the members",
    "His fishing license was issued last spring.",
    "A driving license is needed for this job.",
    "They lost the license for the bar after the inspection.",
    "The teacher got a license to teach in another state.",
    "The pilot must show the license at the gate.",
    "Copyright law was the subject of the lecture.",
    "The warranty of the car had run out by then.",
    "She gave him permission to leave the room early.",
    "Human rights were discussed at the meeting of the foundation.",
    "It comes without a warranty and was sold as is.",
    "The license fee for the radio was raised again.",
)

NONE, UNKNOWN = "none", "unknown"
LINES = 1500
VARIANTS = 60
#: Characters of a corpus line that is learnt from, at most.
LONGEST = 2000
#: Lengths of a line that may be wrapped, and what shows that it is not.
WRAPPED = range(45, 101)
CLOSED = ".:;!?"
#: Words of a line that is compared with the short notices, at most.
SHORT = 8
#: Words of the short notices of more families than this say little about the family.
SHARED = 3
SEED = 11
ROUNDS = 300
_LETTER = re.compile(r"[A-Za-z]")
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
ABOUT = r"(?i)licen[cs]|copyright|warrant|permi|rights|creative|gnu|apache"
#: Words remembered by a worker before it starts over.
REMEMBER = 300_000


def words_of(line: str) -> list[str]:
    """One word (or none) for each blank-delimited stretch, without its punctuation."""
    return [w for w in map(word_of, line.split()) if w]


def word_of(stretch: str) -> str:
    m = _WORD.search(stretch.lower())
    return m[0] if m else ""


def short_notices() -> dict[str, list[str]]:
    """Short notices of each family: its names in every form, and alone if they are no plain word."""
    return {
        f: [form.format(n) for n in names for form in FORMS]
        + [n for n in names if len(words_of(n)) > 1 or re.search(r"\d", n)]
        for f, names in NAMES.items()
    }


def pairs_of(line: str) -> set[tuple[str, str]]:
    w = words_of(line)
    return set(zip(w, w[1:])) or {(x, "") for x in w}


@dataclass
class Model:
    families: list[str]
    words: dict[str, int]
    #: Feature of (word, word), 0 for none.
    pairs: np.ndarray
    #: (feature, class); row 0 is zero.
    weights: np.ndarray
    bias: np.ndarray
    cut: float = 0.5
    #: Likeness to a notice of the family that confirms it.
    confirm: float = 0.6
    #: A notice has less probability of `none` than this, and at least this likeness to some notice.
    none: float = 0.5
    near: float = 0.0


def _features(line: str, m: Model) -> np.ndarray:
    ids = np.asarray([m.words.get(w, 0) for w in words_of(line)], np.int64)
    two = m.pairs[ids[:-1], ids[1:]] if len(ids) > 1 else np.zeros(0, np.int64)
    out = np.zeros(len(m.weights), np.float32)
    np.add.at(out, ids, 1)
    np.add.at(out, two, 1)
    out[0] = 0
    return out / max(1.0, out.sum()) ** 0.5


def _variants(line: str, r: np.random.Generator, filler: list[str]) -> str:
    """A notice as found in the wild: a stretch of it, with a word lost and words around it."""
    w = line.split()
    if len(w) > 12:
        n = int(r.integers(max(8, int(0.6 * len(w))), len(w) + 1))
        a = int(r.integers(0, len(w) - n + 1))
        w = w[a : a + n]
    if len(w) > 6 and r.random() < 0.3:
        del w[int(r.integers(0, len(w)))]
    if filler and r.random() < 0.4:
        more = [filler[int(i)] for i in r.integers(0, len(filler), int(r.integers(1, 7)))]
        w = more + w if r.random() < 0.5 else w + more
    return " ".join(w)


def probabilities(m: Model, x: np.ndarray) -> np.ndarray:
    z = x @ m.weights + m.bias
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(lines: list[str], seed: int = SEED) -> Model:
    """Fits the regression and its cut; `lines` are corpus lines about other things."""
    r = np.random.default_rng(seed)
    families = [NONE, *sorted(NOTICES)]
    short = short_notices()
    known = [n for f in families[1:] for n in (*NOTICES[f], *short.get(f, ()))]
    vocabulary = sorted({w for line in [*known, *PLAIN, *OTHERS] for w in words_of(line)})
    words = {w: i + 1 for i, w in enumerate(vocabulary)}
    two = sorted({p for line in known for p in zip(words_of(line), words_of(line)[1:])})
    pairs = np.zeros((len(words) + 1, len(words) + 1), np.int64)
    for i, (a, b) in enumerate(two):
        pairs[words[a], words[b]] = len(words) + 1 + i
    size = 1 + len(words) + len(two)
    weights = np.zeros((size, len(families)), np.float32)
    m = Model(families, words, pairs, weights, np.zeros(len(families), np.float32))
    filler = [w for line in lines[:200] for w in line.split()[:20]]
    # A fifth of the corpus lines is kept for calibration.
    apart, lines = lines[::5], [x for i, x in enumerate(lines) if i % 5]
    texts, y = [*PLAIN, *lines], [0] * (len(PLAIN) + len(lines))
    held: list[tuple[str, str]] = []
    for c, f in enumerate(families[1:], 1):
        for line in NOTICES[f]:
            made = [line, *[_variants(line, r, filler) for _ in range(VARIANTS)]]
            held += [(x, f) for x in made[-VARIANTS // 5 :]]
            texts += made[: -VARIANTS // 5]
            y += [c] * (len(made) - VARIANTS // 5)
        texts += 2 * short.get(f, [])
        y += [c] * 2 * len(short.get(f, []))
    x = np.stack([_features(t, m) for t in texts])
    target = np.eye(len(families), dtype=np.float32)[y]
    share = target.sum(axis=0)
    weight = (len(y) / len(families) / share)[np.asarray(y)][:, None].astype(np.float32)
    past_w, past_b = np.full_like(m.weights, 1e-6), np.full_like(m.bias, 1e-6)
    for _ in range(ROUNDS):
        g = (probabilities(m, x) - target) * weight / len(y)
        g_w, g_b = x.T @ g + 1e-5 * m.weights, g.sum(axis=0)
        past_w += g_w * g_w
        past_b += g_b * g_b
        m.weights -= 0.3 * g_w / np.sqrt(past_w)
        m.bias -= 0.3 * g_b / np.sqrt(past_b)
    m.weights[0] = 0
    inside = probabilities(m, np.stack([_features(t, m) for t, _ in held]))[:, 1:].max(axis=1)
    outside = probabilities(m, np.stack([_features(t, m) for t in OTHERS]))[:, 1:].max(axis=1)
    cuts = np.unique(np.concatenate([inside, outside]))
    good = [(inside >= c).mean() + (outside < c).mean() for c in cuts]
    # Among the best cuts the middle one; wording decides where probabilities cannot.
    best = cuts[np.flatnonzero(np.isclose(good, max(good)))]
    m.cut = float(min(best[len(best) // 2], np.quantile(inside, 0.02)))
    m.confirm = _confirming(m, held)
    m.none, m.near = _lower(m, list(OTHERS), [*PLAIN, *apart])
    return m


def _confirming(m: Model, held: list[tuple[str, str]]) -> float:
    """The likeness that best tells held-out variants of notices from unlisted notices, midway between
    the two groups there."""
    scanner = Scanner(m)
    inside = np.asarray([scanner.similarity(t, f) for t, f in held])
    outside = np.asarray([max(scanner.similarity(t, f) for f in m.families[1:]) for t in OTHERS])
    cuts = np.unique(np.concatenate([inside, outside]))
    good = [(inside >= c).mean() + (outside < c).mean() for c in cuts]
    best = float(cuts[int(np.argmax(good))])
    return (best + float(outside[outside < best].max(initial=0.0))) / 2


def _lower(m: Model, unlisted: list[str], plain: list[str]) -> tuple[float, float]:
    """The two limits that best tell `unlisted` notices from `plain` lines, each midway between what
    it must let through and the next plain line that it keeps out."""
    scanner = Scanner(m)
    none = {k: probabilities(m, np.stack([_features(t, m) for t in g]))[:, 0] for k, g in ((1, unlisted), (0, plain))}
    near = {k: np.asarray([max(scanner.similarity(t, f) for f in m.families[1:]) for t in g]) for k, g in ((1, unlisted), (0, plain))}
    tries = [
        ((none[1] <= a) & (near[1] >= b)).mean() - ((none[0] <= a) & (near[0] >= b)).mean()
        for a in none[1]
        for b in near[1]
    ]
    at = int(np.argmax(tries))
    a, b = float(none[1][at // len(near[1])]), float(near[1][at % len(near[1])])
    above = none[0][(near[0] >= b) & (none[0] > a)].min(initial=1.0)
    below = near[0][(none[0] <= a) & (near[0] < b)].max(initial=0.0)
    return (a + float(above)) / 2, (b + float(below)) / 2


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES
) -> Model:
    """Trains with a sample of lines of `docs`."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    one = F.lit(1).alias("all")
    picked = class_sample(rows.filter(F.col("text").isNotNull()).select("doc_id", one), "doc_id", "all", lines)
    ids = F.broadcast(picked.select(F.col("doc_id").alias("p_id")).distinct())
    each = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S") & ~x.rlike(ABOUT))
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.size("each"), F.lit(1))).cast("int")
    some = (
        rows.join(ids, F.col("doc_id") == F.col("p_id"), "left_semi")
        .select("doc_id", each.alias("each"))
        .select("doc_id", F.substring(F.get("each", place), 1, LONGEST).alias("line"))
        .filter(F.col("line").isNotNull())
    )
    one = top_k(some, ["doc_id"], [F.xxhash64("line"), F.col("line")], 1)
    return train([r.line for r in sorted(one.collect(), key=lambda r: (r.doc_id, r.line))])


def paragraphs(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the paragraphs of a text, in code points."""
    found, at, open_ = [], 0, False
    for line in (text or "").split("\n"):
        end = at + len(line)
        if not line or line.isspace():
            open_ = False
        else:
            if open_:
                found[-1] = (found[-1][0], end)
            else:
                found.append((at, end))
            open_ = len(line) in WRAPPED and line.rstrip()[-1] not in CLOSED
        at = end + 1
    return found


class Scanner:
    """Finds licence paragraphs in texts, many lines at a time."""

    def __init__(self, m: Model) -> None:
        self.model = m
        self.notices = {f: [pairs_of(n) for n in lines] for f, lines in NOTICES.items()}
        #: Families whose notices have a pair.
        self.spread = Counter(p for notices in self.notices.values() for p in set().union(*notices))
        short = {f: [frozenset(words_of(n)) for n in lines] for f, lines in short_notices().items()}
        self.short = {f: list(set(notices)) for f, notices in short.items()}
        spread = Counter(w for notices in self.short.values() for w in frozenset().union(*notices))
        self.common = {w for w, n in spread.items() if n > SHARED}
        self.known: dict[str, int] = {}

    def ids(self, stretches: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBER:
            known.clear()
        for w in set(stretches).difference(known):
            plain = word_of(w)
            known[w] = self.model.words.get(plain, 0) if plain else -1
        return np.fromiter(map(known.__getitem__, stretches), np.int64, len(stretches))

    def similarity(self, line: str, family: str) -> float:
        mine = pairs_of(line)
        best = 0.0
        for notice in self.notices[family]:
            if min(len(mine), len(notice)) >= min(3, len(notice)):
                best = max(best, self.told(mine & notice) / min(self.told(mine), self.told(notice)))
        each = words_of(line)
        if 0 < len(each) <= SHORT:
            words = frozenset(each)
            for notice in self.short.get(family, ()):
                best = max(best, self.weight(words & notice) / self.weight(words | notice))
        return best

    def told(self, pairs: set[tuple[str, str]]) -> float:
        """How much pairs say about a family: one that no notice or one family has counts whole."""
        return sum(1 / max(1, self.spread[p]) for p in pairs)

    def weight(self, words: frozenset[str]) -> float:
        return sum(0.5 if w in self.common else 1.0 for w in words)

    def scan(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int, int, str, float, float]]]]:
        """For each text its number of paragraphs and its findings: (paragraph, start, end, family or
        unknown, probability, similarity); start and end are code points."""
        lines, owner, places = [], [], []
        counts = []
        for t, text in enumerate(texts):
            n = 0
            for start, end in paragraphs(text):
                lines.append(text[start:end])
                owner.append(t)
                places.append((n, start))
                n += 1
            counts.append(n)
        found: list[list] = [[] for _ in texts]
        if lines:
            parts = [line.split() for line in lines]
            sizes = np.asarray([len(p) for p in parts])
            ids = self.ids([w for p in parts for w in p])
            row = np.repeat(np.arange(len(lines)), sizes)
            real = ids >= 0
            ids, row = ids[real], row[real]
            m = self.model
            two = m.pairs[ids[:-1], ids[1:]] * (row[:-1] == row[1:])
            one_at, two_at = np.flatnonzero(ids), np.flatnonzero(two)
            feature = np.concatenate([ids[one_at], two[two_at]])
            at = np.concatenate([row[one_at], row[two_at]])
            total = np.bincount(at, minlength=len(lines))
            z = np.stack(
                [np.bincount(at, m.weights[feature, c], len(lines)) for c in range(len(m.families))],
                axis=1,
            )
            z = z / np.sqrt(np.maximum(total, 1))[:, None] + m.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i in np.flatnonzero(p[:, 0] < m.none):
                # Numbers and signs alone are no notice.
                if not _LETTER.search(lines[i]):
                    continue
                c = int(p[i, 1:].argmax()) + 1
                near = self.similarity(lines[i], m.families[c])
                sure = p[i, c] >= m.cut and near >= m.confirm
                # The likeness to any family's notices tells unlisted notices from other lines.
                if not sure and max(self.similarity(lines[i], f) for f in m.families[1:]) < m.near:
                    continue
                n, start = places[i]
                found[owner[i]].append(
                    (n, start, start + len(lines[i]), m.families[c] if sure else UNKNOWN, float(p[i, c]), near)
                )
        return list(zip(counts, found))


def scan(df: DataFrame, m: Model, text_col: str = "text", spans: bool = False) -> DataFrame:
    """`df` without its text and with n_paragraphs, n_license (confirmed ones), n_unknown, families
    (sorted, joined by '|'), license (the most frequent), probability (the highest of a confirmed
    one) and, if asked for, spans (paragraph, start, end, family, probability, similarity). Names
    that `df` has already get an underscore."""
    ship(df.sparkSession)
    place = df.columns.index(text_col)
    span = "array<struct<paragraph:int,start:int,end:int,family:string,probability:double,similarity:double>>"
    kinds = {
        "n_paragraphs": "int",
        "n_license": "int",
        "n_unknown": "int",
        "families": "string",
        "license": "string",
        "probability": "double",
    } | ({"spans": span} if spans else {})
    rest = df.drop(text_col)
    names = fresh(rest, *kinds)
    shared = df.sparkSession.sparkContext.broadcast(m)
    types = T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in kinds.items()))
    span_type = pa.list_(
        pa.struct(
            [
                ("paragraph", pa.int32()),
                ("start", pa.int32()),
                ("end", pa.int32()),
                ("family", pa.string()),
                ("probability", pa.float64()),
                ("similarity", pa.float64()),
            ]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for rows in batches:
            found = []
            for at in range(0, len(rows), 500):
                found += scanner.scan(rows.column(place).slice(at, 500).to_pylist())
            sure = [[s for s in f if s[3] != UNKNOWN] for _, f in found]
            by = [Counter(s[3] for s in f) for f in sure]
            cols = [
                pa.array([n for n, _ in found], pa.int32()),
                pa.array([len(s) for s in sure], pa.int32()),
                pa.array([len(f) - len(s) for (_, f), s in zip(found, sure)], pa.int32()),
                pa.array(["|".join(sorted(b)) for b in by], pa.string()),
                pa.array([min(b, key=lambda x: (-b[x], x)) if b else None for b in by], pa.string()),
                pa.array([max((s[4] for s in f), default=0.0) for f in sure], pa.float64()),
            ]
            if spans:
                keys = [f.name for f in span_type.value_type]
                cols.append(pa.array([[dict(zip(keys, s)) for s in f] for _, f in found], span_type))
            others = [c for i, c in enumerate(rows.columns) if i != place]
            yield pa.RecordBatch.from_arrays([*others, *cols], names=schema.names)

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    kept = [f for i, f in enumerate(plain.schema.fields) if i != place]
    schema = T.StructType([*kept, *types.fields])
    return plain.mapInArrow(run, schema).toDF(*rest.columns, *names)
