"""License scans by conditional compression.

Candidate blocks are stretches of words that hold an anchor of a template: a few words of
it in a row. Each block is compressed alone and with every template that has an anchor there as zstandard's raw
dictionary. What a template saves ranks it: templates that save too little of their own size are left out,
and from the largest saving on the next template whose place is still free is confirmed by the exact differences in
wording, the words of the template that the text lacks and those it has in between. So of
templates whose places overlap the one that explains most bytes of the text wins, if the wording bears it out. Short
statements must have every word, long notices nearly all, and all words that tell a family's licenses apart. A long notice has more
anchors, side by side, than it may have differences, so no text that would be confirmed lacks all of them.
"""

from __future__ import annotations

import bisect
import collections
import functools
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimforge.llm import arrow

# Names of licenses as short statements write them.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License, Version 2", "Apache License 2.0", "Apache 2.0 License"),
    "MIT": ("MIT License",),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2", "GNU GPL version 2", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3", "GNU GPL version 3", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License v2.0", "Eclipse Public License 2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "CC0-1.0": ("CC0 1.0",),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "Unlicense": ("Unlicense",),
}
# Statements around a name.
STATEMENTS = (
    "Licensed under the {}.", "Licensed under {}.", "Licensed under a {}.", "Licensed under the terms of the {}.", "Released under the {}.", "Distributed under the {}.",
    "Available under the {}.", "Available under the terms of the {}.", "This work is licensed under the {}.", "This work is licensed under a {}.", "License: {}",
)
# Identifiers that say whether later versions are meant, and the first lines of long licenses' own texts.
SUFFIXED = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
HEADS = {
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "Apache-2.0": "Apache License Version 2.0, January 2004",
    "MPL-2.0": "Mozilla Public License Version 2.0 1. Definitions",
    "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003",
    "EPL-2.0": "Eclipse Public License - v 2.0",
}
# Notices of licenses in full.
NOTICES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
    "this software to the public domain worldwide.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
    "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
    "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
    "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
    "product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must "
    "be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
    "altered from any source distribution.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.",
}
# The clauses that longer notices add, and the notices of a family of licenses.
NAME_CLAUSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)
NOTICE_CLAUSE = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product "
    "includes software developed by the organization."
)
FAMILY = (
    "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published "
    "by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
FAMILY_ONLY = (
    "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published "
    "by the Free Software Foundation; version {} of the License."
)
MEMBERS = {
    "GPL-2.0": ("program", "", "2"),
    "GPL-3.0": ("program", "", "3"),
    "LGPL-2.1": ("library", "Lesser ", "2.1"),
    "LGPL-3.0": ("program", "Lesser ", "3"),
    "AGPL-3.0": ("program", "Affero ", "3"),
}
# Words by which a family's licenses differ.
TELLING = ("lesser", "affero", "1", "2", "2.1", "3")
_WORD = re.compile(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*")
_BLANK = re.compile(r"\n[^\S\n]*\n")
# Most words of an anchor.
ANCHOR = 4


def notices() -> list[tuple[str, str]]:
    two = NOTICES["BSD-2-Clause"]
    longer = [("BSD-3-Clause", f"{two} 3. {NAME_CLAUSE}"), ("BSD-4-Clause", f"{two} 3. {NOTICE_CLAUSE} 4. {NAME_CLAUSE}")]
    return [*NOTICES.items(), *longer, *((k, f.format(*v)) for f in (FAMILY, FAMILY_ONLY) for k, v in MEMBERS.items())]


def identifiers() -> dict[str, str]:
    """Identifiers of file headers, and the license that each names."""
    plain = [*NAMES, "BSD-4-Clause"]
    return {k: k for k in plain} | {f"{k}-{end}": k for k in SUFFIXED for end in ("only", "or-later")}


def templates() -> list[tuple[str, str]]:
    out = [(k, s.format(n)) for k, names in NAMES.items() for n in names for s in STATEMENTS]
    out += [(k, f"SPDX-License-Identifier: {i}") for i, k in identifiers().items()]
    return out + list(HEADS.items()) + notices()


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def wording(theirs: list[str], mine: list[str]) -> tuple[int, int, int, int]:
    """``(missing, extra, begin, end)``: the stretch of ``mine`` that differs from ``theirs`` in fewest words, the shortest if several do."""
    number = {w: k for k, w in enumerate(dict.fromkeys(theirs))}
    codes = np.array([number.get(w, -1) for w in mine], np.int64)
    # Row i holds, for each end, the fewest differences of the first i words, above how far the stretch begins before the text's end.
    one = np.int64(1) << 32
    ends = np.arange(len(mine) + 1, dtype=np.int64)
    row = len(mine) - ends
    for w in theirs:
        step = row + one
        step[1:] = np.minimum(step[1:], np.where(codes == number[w], row[:-1], step[1:]))
        row = np.minimum.accumulate(step - ends * one) + ends * one
    end = int(np.argmin(row))
    cost, begin = int(row[end] >> 32), len(mine) - int(row[end] & (one - 1))
    missing = (cost + len(theirs) - (end - begin)) // 2
    return missing, cost - missing, begin, end


class Scanner:
    def __init__(self, least_gain: float, long_words: int, most_missing: float):
        self.known = [(k, words(t)) for k, t in templates()]
        self.least_gain = least_gain
        raw = zstandard.DICT_TYPE_RAWCONTENT
        plain = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.alone = zstandard.ZstdCompressor(**plain)
        blocks = [" ".join(w).encode() for _, w in self.known]
        self.given = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(b, raw), **plain) for b in blocks]
        self.own = [len(self.alone.compress(b)) for b in blocks]
        self.slack = [int(most_missing * len(w)) if len(w) >= long_words else 0 for _, w in self.known]
        family = {tuple(words(f.format(*v))) for f in (FAMILY, FAMILY_ONLY) for v in MEMBERS.values()}
        self.telling = [frozenset(TELLING) if tuple(w) in family else frozenset() for _, w in self.known]
        self.identifiers = {i.lower(): k for i, k in identifiers().items()}
        # By width: anchors, with the templates that have them and where. Each difference spoils one of those side by side.
        self.anchors: dict[int, dict[tuple, list[tuple[int, int]]]] = {}
        for k, (_, w) in enumerate(self.known):
            spoilt = 2 * self.slack[k]
            width = max(1, min(ANCHOR, len(w) // (spoilt + 1)))
            for p in range(0, len(w) - width + 1 if spoilt else 1, width):
                self.anchors.setdefault(width, {}).setdefault(tuple(w[p : p + width]), []).append((k, p))

    def find(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """``(start, end, license, missing words, extra words)`` in code points, left to right without overlap."""
        mine = words(text)
        places: dict[int, set[int]] = {}
        for width, known in self.anchors.items():
            rows = lambda n=width: zip(*(islice(mine, j, None) for j in range(n)))
            if known.keys().isdisjoint(rows()):
                continue
            for i, row in enumerate(rows()):
                for k, p in known.get(row, ()):
                    places.setdefault(k, set()).add(i - p)
        if not places:
            return []
        spots = [m.span() for m in _WORD.finditer(text)]
        ranked, windows = [], collections.defaultdict(list)
        for k, starts in places.items():
            reach = -len(mine) - 1
            for at in sorted(starts):  # a window takes up all starts within the slack
                if at > reach:
                    reach = at + self.slack[k]
                    windows[k].append(at)
                    if (saved := self._saved(k, at, mine)) >= self.least_gain * self.own[k]:
                        ranked.append((-saved, at, k))
        out: list[tuple[int, int, str, int, int]] = []
        for _, at, k in sorted(ranked):
            # Parts that a long notice repeats give it windows a little beside each other: of those the wording decides.
            beside = windows[k][bisect.bisect_left(windows[k], at - 4 * self.slack[k]) : bisect.bisect(windows[k], at + 4 * self.slack[k])]
            hits = [hit for x in beside if (hit := self._confirmed(k, x, mine))]
            if not hits:
                continue
            begin, end, missing, extra = min(hits, key=lambda x: (x[2] + x[3], x))
            start, stop = spots[begin][0], spots[end - 1][1]
            if not self.slack[k] and _BLANK.search(text, start, stop):
                continue
            i = bisect.bisect(out, (start,))
            if (i == 0 or out[i - 1][1] <= start) and (i == len(out) or stop <= out[i][0]):
                out.insert(i, (start, stop, self.known[k][0], missing, extra))
                if mine[begin] == "spdx-license-identifier":
                    out[i + 1 : i + 1] = self._alternatives(mine, end, spots)
        return out

    def _alternatives(self, mine: list[str], at: int, spots: list[tuple[int, int]]) -> list[tuple[int, int, str, int, int]]:
        """The further identifiers of an expression, each after ``or`` or ``and``."""
        out = []
        while at + 1 < len(mine) and mine[at] in ("or", "and") and mine[at + 1] in self.identifiers:
            out.append((*spots[at + 1], self.identifiers[mine[at + 1]], 0, 0))
            at += 2
        return out

    def _window(self, k: int, at: int, mine: list[str]) -> tuple[int, list[str]]:
        first = max(0, at - self.slack[k])
        return first, mine[first : max(0, at + len(self.known[k][1]) + 2 * self.slack[k])]

    def _saved(self, k: int, at: int, mine: list[str]) -> int:
        """Bytes by which the template shortens the block."""
        block = " ".join(self._window(k, at, mine)[1]).encode()
        return len(self.alone.compress(block)) - len(self.given[k].compress(block))

    def _confirmed(self, k: int, at: int, mine: list[str]) -> tuple[int, int, int, int] | None:
        """``(begin, end, missing, extra)`` if the block words the template."""
        theirs, slack = self.known[k][1], self.slack[k]
        first, window = self._window(k, at, mine)
        if not slack:
            return (first, first + len(theirs), 0, 0) if window == theirs else None
        if (collections.Counter(theirs) - collections.Counter(window)).total() > slack:
            return None
        missing, extra, begin, end = wording(theirs, window)
        if missing > slack or extra > slack:
            return None
        told = [sorted(w for w in x if w in self.telling[k]) for x in (theirs, window[begin:end])]
        return (first + begin, first + end, missing, extra) if told[0] == told[1] else None


@functools.lru_cache(maxsize=2)
def _scanner(*limits: float) -> Scanner:
    return Scanner(*limits)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_gain: float = 0.2,
    long_words: int = 20,
    most_missing: float = 0.1,
) -> DataFrame:
    """Per row ``n_licenses, licenses, spans``: distinct ids sorted, and ``id:start:end:missing:extra``, comma-joined.

    Places count code points of the whole text, ends are exclusive. Null and empty
    texts have none; null ids and repeated rows are kept; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _scanner(least_gain, long_words, most_missing).find
        for batch in batches:
            found = [find(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([",".join(sorted({x[2] for x in f})) for f in found], pa.string()),
                    pa.array([",".join(f"{k}:{a}:{b}:{m}:{e}" for a, b, k, m, e in f) for f in found], pa.string()),
                ],
                [id_col, "n_licenses", "licenses", "spans"],
            )

    schema = f"`{id_col}` long, n_licenses long, licenses string, spans string"
    return arrow.in_small_batches(docs).select(F.col(id_col).cast("long"), F.coalesce(text_col, F.lit(""))).mapInArrow(run, schema)


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
