"""Find licence notices, headers and texts by Dice coefficient over word bigrams."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import sized_for, text_batches

LEAST = 0.6

# Short notices by which works say what licence they are under.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Licensed under the 2-clause BSD License.",
    "BSD-3-Clause": "Licensed under the 3-clause BSD License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_BY_GNU = (
    "This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1} as published by "
    "the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)

# The headers of files, as the licences' texts give them.
HEADERS = {
    "AGPL-3.0": _BY_GNU.format(":", "Affero General Public License", 3),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "GPL-2.0": _BY_GNU.format(";", "General Public License", 2),
    "GPL-3.0": _BY_GNU.format(":", "General Public License", 3),
    "LGPL-2.1": _BY_GNU.format(";", "Lesser General Public License", "2.1"),
    "LGPL-3.0": _BY_GNU.format(":", "Lesser General Public License", 3),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}

# Names that say the licence, and the version, by themselves; "under .." one of them counts word for word only.
_GNU = ("{0} v{1}", "{0} v{1}.0", "{0} version {1}", "{0}, version {1}.0", "{0} {1}.0", "{2} v{1}", "{2}v{1}", "{2} {1}", "{2}-{1}.0")
_CC = ("CC {0} 4.0", "Creative Commons {1} 4.0 International", "Creative Commons {1} 4.0")
NAMES = {
    "AGPL-3.0": [x.format("GNU Affero General Public License", 3, "AGPL") for x in _GNU],
    "Apache-1.1": ["Apache License, Version 1.1", "Apache License 1.1", "Apache 1.1"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0", "Apache-2.0 License"],
    "BSD-2-Clause": ["2-clause BSD License", "BSD 2-Clause", "BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["3-clause BSD License", "BSD 3-Clause", "BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "CC-BY-4.0": [x.format("BY", "Attribution") for x in _CC],
    "CC-BY-NC-4.0": [x.format("BY-NC", "Attribution-NonCommercial") for x in _CC],
    "CC-BY-SA-4.0": [x.format("BY-SA", "Attribution-ShareAlike") for x in _CC],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0", "Creative Commons Zero v1.0"],
    "GPL-1.0": [x.format("GNU General Public License", 1, "GPL") for x in _GNU],
    "GPL-2.0": [x.format("GNU General Public License", 2, "GPL") for x in _GNU],
    "GPL-3.0": [x.format("GNU General Public License", 3, "GPL") for x in _GNU],
    "LGPL-2.1": ["GNU Lesser General Public License v2.1", "GNU Lesser General Public License, version 2.1", "LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0": [x.format("GNU Lesser General Public License", 3, "LGPL") for x in _GNU],
    "MIT": ["MIT License", "MIT Licence"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
_UNDER = ("under {0}", "under the {0}", "under a {0}", "under the terms of {0}", "under the terms of the {0}")
# Titles of texts that otherwise hardly differ from one another.
_TITLES = {
    "AGPL-3.0": ["GNU Affero General Public License Version 3, 19 November 2007"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International Public License"],
    "CC-BY-NC-SA-4.0": ["Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Public License"],
}


def known() -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """What is scanned for by default: notices, headers and whole texts, and phrases that count word for word only."""
    # As resources of the package, which may be imported from an archive.
    files = [file for file in resources.files(__package__).joinpath("licence_texts").iterdir() if file.name.endswith(".txt")]
    if not files:
        raise FileNotFoundError("the licence texts were not packaged")
    texts = {file.name.removesuffix(".txt"): file.read_text("utf-8") for file in files}
    alike = {name: [x[name] for x in (TEMPLATES, HEADERS, texts) if name in x] for name in {*TEMPLATES, *HEADERS, *texts}}
    phrases = {name: [under.format(x) for x in names for under in _UNDER] for name, names in NAMES.items()}
    for name, titles in _TITLES.items():
        phrases[name] = phrases.get(name, []) + titles
    return alike, phrases


_TAG = re.compile(rb"spdx-license-identifier:[ \t]*([a-z0-9.+() \t-]+)")
_ID = re.compile(rb"[a-z0-9.-]+")
_SUFFIX = re.compile(rb"(-only|-or-later)$")

_WORD = re.compile(rb"[a-z0-9]+")


def _pairs(text: bytes) -> list[bytes]:
    words = _WORD.findall(text.lower())
    return [a + b" " + b for a, b in zip(words, words[1:], strict=False)]


def bigrams(text: bytes) -> set[bytes]:
    """The different pairs of neighbouring words; words are runs of a-z and 0-9 after A-Z is lower-cased."""
    return set(_pairs(text))


class Templates:
    """Templates by their bigrams: texts of each licence, and phrases that count only if all is the same.

    A template is a licence's name, its place among the licence's, and its least coefficient if that is fixed.
    """

    def __init__(self, texts: dict[str, str | list[str]], phrases: dict[str, list[str]] | None = None):
        listed = {name: [own] if isinstance(own, str) else own for name, own in texts.items()}
        sets = {(name, i, 0.0): bigrams(x.encode()) for name, own in listed.items() for i, x in enumerate(own)}
        sets |= {(name, i, 1.0): bigrams(x.encode()) for name, own in (phrases or {}).items() for i, x in enumerate(own)}
        self.tags = {name.lower().encode(): name for name in [*texts, *phrases]} if phrases else {}
        self.sets = {key: found for key, found in sorted(sets.items()) if found}
        self.sizes = {key: len(found) for key, found in self.sets.items()}
        self.having: dict[bytes, list[tuple[str, int, float]]] = {}
        for key, found in self.sets.items():
            for bigram in found:
                self.having.setdefault(bigram, []).append(key)

    def best(self, text: bytes, least: float) -> tuple[float, str] | None:
        """The greatest coefficient, if it is ``least`` or more; of equals the first template by name.

        The coefficient of sets of a and b bigrams is 2 min(a, b) / (a + b) at most, so only templates whose size is
        within bounds of the text's are compared.
        """
        found = bigrams(text)
        n, low, high = len(found), least / (2 - least), (2 - least) / least
        common = Counter(key for bigram in found & self.having.keys() for key in self.having[bigram])
        near = ((key, count) for key, count in common.items() if low * self.sizes[key] <= n <= high * self.sizes[key])
        scored = [(2 * count / (n + self.sizes[key]), key) for key, count in near]
        passing = [(dice, key[0]) for dice, key in scored if dice >= max(least, key[2])]
        return min(passing, key=lambda x: (-x[0], x[1])) if passing else None

    def _tagged(self, text: bytes) -> list[tuple[float, str, int, int]]:
        """The licences that SPDX tags name, as spans: each one where it is named first."""
        spans = {}
        lower = text.lower()
        for tag in _TAG.finditer(lower) if self.tags else ():
            for found in _ID.finditer(tag[1]):
                name = self.tags.get(_SUFFIX.sub(b"", found[0]))
                if name and name not in spans:
                    first, behind = (len(_WORD.findall(lower[:end])) for end in (tag.start(), tag.start(1) + found.end()))
                    spans[name] = (1.0, name, first, behind)
        return list(spans.values())

    def spans(self, text: bytes, least: float) -> list[tuple[float, str, int, int]]:
        """Of each template the span of words most like it, if ``least`` alike: coefficient, name, first word, word behind.

        A template of which the text has fewer than ``least / (2 - least)`` of the bigrams, in whatever places, is like no
        span of it, and is not searched for. With phrases, SPDX tags are spans too.
        """
        pairs = _pairs(text)
        found = set(pairs)
        common = Counter(key for bigram in found & self.having.keys() for key in self.having[bigram])
        keys = sorted(key for key, count in common.items() if count >= _needed(self.sizes[key], max(least, key[2])))
        spans = self._tagged(text)
        if not keys:
            return spans
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(pair, len(numbers)) for pair in pairs])
        order = np.argsort(ids, kind="stable")
        before = np.full(len(ids), -1)
        again = ids[order[1:]] == ids[order[:-1]]
        before[order[1:][again]] = order[:-1][again]
        for key in keys:
            wanted = np.zeros(len(numbers), bool)
            wanted[[numbers[bigram] for bigram in self.sets[key] & found]] = True
            best = _best_window(wanted[ids], before, self.sizes[key], max(least, key[2]))
            if best:
                spans.append((best[0], key[0], best[1], best[2] + 1))
        return spans


def _needed(size: int, least: float) -> int:
    """So many common bigrams make a set ``least`` like one of ``size``, at the fewest; never more for rounding."""
    return max(1, math.ceil(least * size / (2 - least) - 1e-9))


def _best_window(hit: np.ndarray, before: np.ndarray, size: int, least: float) -> tuple[float, int, int] | None:
    """The window of places most like a set of ``size``: coefficient, first place, place behind; of equals the first.

    ``hit`` says whether a place's bigram is in the set, ``before`` where the same bigram stood last. A window has the
    places that a set within the size bounds could have without repeats, at most. The best one begins with a hit, as
    without other places in front it is no less alike. Windows that begin ``d`` places later have the common bigrams of
    the same end at most, and ``d`` different ones fewer at most: by that bound ranges of beginnings are left out, best first.
    """
    reach = max(1, math.floor((2 - least) / least * size + 1e-9))
    places = np.flatnonzero(hit)
    starts = places[np.searchsorted(places, places + reach) - np.arange(len(places)) >= _needed(size, least)]
    best: tuple[float, int, int] | None = None

    def behind(most: float, place: int) -> bool:
        """Whether windows at most so alike, beginning here or later, are no better than the best."""
        return most < least or (best is not None and (-most, place) > (-best[0], best[1]))

    def bound(common: np.ndarray, different: np.ndarray, later: int) -> float:
        return float((2 * common / (np.maximum(different - later, common) + size)).max())

    edges = [0, *(np.flatnonzero(np.diff(starts // reach)) + 1).tolist(), len(starts)]
    ranges = [(-math.inf, a, b) for a, b in zip(edges, edges[1:], strict=False) if a < b]
    while ranges:
        most, a, b = heapq.heappop(ranges)
        start = int(starts[a])
        if behind(-most, start):
            continue
        new = before[start : start + 2 * reach] < start
        different = np.cumsum(new)
        common = np.cumsum(new & hit[start : start + 2 * reach])
        dice = 2 * common[:reach] / (different[:reach] + size)
        end = int(dice.argmax())
        if dice[end] >= least and (not best or (-dice[end], start) < (-best[0], best[1])):
            best = (float(dice[end]), start, start + end + 1)
        middle = (a + 1 + b) // 2
        for low, high in ((a + 1, middle), (middle, b)):
            if low < high:
                most = bound(common, different, int(starts[high - 1]) - start)
                if not behind(most, int(starts[low])):
                    heapq.heappush(ranges, (-most, low, high))
    return best


_MATCH = T.StructType(
    [T.StructField("unit", T.IntegerType()), T.StructField("licence", T.StringType()), T.StructField("dice", T.DoubleType())]
)
_SPAN = T.StructType(
    [
        *_MATCH.fields,
        T.StructField("first_word", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
        T.StructField("apart", T.BooleanType()),
    ]
)


def _matches(templates: Templates, least: float, text: bytes) -> tuple[list[dict], list[dict]]:
    """What ``scan`` says of a text: matches and spans."""
    lines = text.split(b"\n")
    units = [text, *lines] if len(lines) > 1 else [text]
    best = [(unit, templates.best(part, least)) for unit, part in enumerate(units)]
    matches = [{"unit": unit, "licence": found[1], "dice": found[0]} for unit, found in best if found]
    spans = templates.spans(text, least)
    if not spans:
        return matches, []
    ends = np.cumsum([len(_WORD.findall(line.lower())) for line in lines])  # of each line, in words of the text
    taken = [(0, int(ends[-1])) if unit == 0 else (int(ends[unit - 2]) if unit > 1 else 0, int(ends[unit - 1])) for unit in (m["unit"] for m in matches)]
    rows = []
    for dice, name, first, behind in sorted(spans, key=lambda x: (-x[0], x[2], x[1])):
        apart = all(behind <= a or b <= first for a, b in taken)
        if apart:
            taken.append((first, behind))
        unit = int(np.searchsorted(ends, first, "right")) + 1 if len(lines) > 1 else 0
        rows.append({"unit": unit, "licence": name, "dice": dice, "first_word": first, "n_words": behind - first, "apart": apart})
    return matches, rows


def _scanned(templates: Templates, least: float):
    match = [("unit", pa.int32()), ("licence", pa.string()), ("dice", pa.float64())]
    span = [*match, ("first_word", pa.int32()), ("n_words", pa.int32()), ("apart", pa.bool_())]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            found = [_matches(templates, least, text) for text in texts]
            matches = pa.array([m for m, _ in found], pa.list_(pa.struct(match)))
            spans = pa.array([s for _, s in found], pa.list_(pa.struct(span)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), matches, spans], ["row", "matches", "spans"])

    return rows


def scan(docs: DataFrame, templates: dict[str, str | list[str]] | None = None, least: float = LEAST) -> DataFrame:
    """``row`` (the document's columns but the text, as a struct), ``matches`` (unit, licence, dice) and ``spans`` (the same
    of the unit that a span begins in, ``first_word`` from 0, ``n_words``, ``apart``).

    Unit 0 is the whole text, units from 1 its lines; a text of one line is unit 0 only. Each unit has the template most
    like it, if that is at least ``least`` alike. Spans are runs of words, in a line or over several, at most as long as a
    text that could be ``least`` like the template: each template has the one most like it, under the same condition, best
    first. Without ``templates``, ``known()`` is scanned for, and the ids of SPDX tags. A span is ``apart`` if it has no word of a unit that matches or of a better span that is apart. Null and empty
    texts, and texts of one word, match nothing. Repeated rows are scanned each for itself.
    """
    sized_for(docs)
    rows = docs.select("text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))
    fields = [
        T.StructField("row", rows.schema["row"].dataType),
        T.StructField("matches", T.ArrayType(_MATCH)),
        T.StructField("spans", T.ArrayType(_SPAN)),
    ]
    return rows.mapInArrow(_scanned(Templates(templates) if templates else Templates(*known()), least), T.StructType(fields))


def licence_digest(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_matched`` units and spans apart from them, and the best match.

    The best has the greatest ``dice``, a unit coming before a span, then the least ``unit``, which of a span is the one
    that it begins in.
    """
    ranked = lambda name, later: F.transform(
        name,
        lambda m: F.struct((-m["dice"]).alias("minus"), F.lit(later).alias("later"), m["unit"].alias("unit"), m["licence"].alias("licence")),
    )
    best = F.array_min(F.concat(ranked("matches", 0), ranked("spans", 1)))
    return scan(docs.select("doc_id", "text")).select(
        F.col("row")["doc_id"].alias("doc_id"),
        (F.size("matches") + F.size(F.filter("spans", lambda s: s["apart"]))).cast("long").alias("n_matched"),
        best["licence"].alias("licence"),
        (-best["minus"]).alias("dice"),
        best["unit"].alias("unit"),
    )
