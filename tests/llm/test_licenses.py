"""op3: statements inside long lines, and several on one line."""

import itertools
import random

import pytest

from claimforge.llm import licenses

PROSE = "the river carried small boats along its banks while people from both towns sold bread cloth and salt in the old market".split()
SCANNER = licenses.Scanner(0.2, 20, 0.1)


def prose(rng, size):
    out = ""
    while len(out) < size:
        out += rng.choice(PROSE) + " "
    return out[:size] + " "


@pytest.mark.parametrize("size", [30, 100, 2_500])
def test_statements_inside_long_lines(size):
    rng = random.Random(size)
    for kind, template in licenses.templates():
        before = prose(rng, size)
        found = SCANNER.find(before + template + " " + prose(rng, size))
        assert [(f[2], f[0]) for f in found] == [(kind, len(before))], template


def test_two_licenses_on_one_line():
    known = licenses.templates()
    for (one, first), (two, second) in itertools.product(known[::3], known[::7]):
        found = SCANNER.find(f"{first} {second}")
        assert [f[2] for f in found] == [one, two], (first, second)


def test_two_licenses_below_a_cue():
    found = SCANNER.find("It has a license of its own,\nsee there. Licensed under the MIT License.\nLicensed under the GNU Affero General Public License, version 3.")
    assert [f[2] for f in found] == ["MIT", "AGPL-3.0"]


def test_notices_nearly_as_known():
    for kind, template in licenses.notices():
        words = template.split()
        del words[next(i for i in range(len(words) // 2, len(words)) if "/" not in words[i])]  # one word, not two
        words.insert(len(words) // 3, "surely")
        found = SCANNER.find("of the software and " + " ".join(words) + " the license of the boats")
        assert [f[2:] for f in found] == [(kind, 1, 1)], template


def test_wording_agrees_with_all_stretches():
    rng = random.Random(3)
    for _ in range(60):
        theirs = [rng.choice("abcde") for _ in range(rng.randint(1, 9))]
        mine = [rng.choice("abcdefg") for _ in range(rng.randint(0, 14))]
        best = min(_differences(theirs, mine[i:j]) for i in range(len(mine) + 1) for j in range(i, len(mine) + 1))
        missing, extra, begin, end = licenses.wording(theirs, mine)
        assert missing + extra == best == _differences(theirs, mine[begin:end])


def _differences(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] if x == y else len(a) + len(b)))
        row = new
    return row[-1]


def test_notices_with_as_many_differences_as_allowed_agree_with_every_window():
    rng = random.Random(7)
    for kind, template in licenses.notices():
        theirs = licenses.words(template)
        most = int(0.1 * len(theirs))
        for _ in range(4):
            mine = list(theirs)
            able = [i for i in range(1, len(mine) - 1) if mine[i] not in licenses.TELLING]
            for i in sorted(rng.sample(able, most), reverse=True):
                del mine[i]
            for _ in range(most):
                mine.insert(rng.randrange(1, len(mine)), f"w{rng.randrange(99)}")
            text = prose(rng, 300) + " ".join(mine) + " " + prose(rng, 300)
            missing, extra, begin, end = licenses.wording(theirs, licenses.words(text))
            if missing <= most and extra <= most:  # it is found as itself, or its place as a template that saves more
                spots = [m.span() for m in licenses._WORD.finditer(text)]
                a, b = spots[begin][0], spots[end - 1][1]
                assert any(x < b and a < y and (k == kind or k.startswith("BSD")) for x, y, k, *_ in SCANNER.find(text)), (kind, text)


def test_kinds_of_one_family_are_told_apart():
    for kind, template in licenses.notices():
        shown = "/*\n * " + template.upper().replace(". ", ".\n *\n * ") + "\n */"
        found = SCANNER.find(prose(random.Random(1), 50) + shown)
        assert [(f[2], f[3], f[4]) for f in found] == [(kind, 0, 0)], kind


def test_nothing_in_texts_about_licenses():
    for text in ("", " ", "free software and its license", "Permission is hereby granted.", "licensed under the\n\nMIT License", "İ" * 50 + " software license"):
        assert SCANNER.find(text) == []


@pytest.mark.parametrize("cue", ["Licensed under the MIT ", "copies of the Software ", "Permission is hereby granted, "])
def test_many_anchors_take_linear_time(cue):
    import time

    took = []
    for n in (2_000, 8_000):
        start = time.perf_counter()
        assert SCANNER.find(cue * n) == []
        took.append(time.perf_counter() - start)
    assert took[1] < 12 * took[0] + 0.5 and took[1] < 20


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("Distributed under the MIT License.", ["MIT"]), ("It is available under the terms of the MIT license", ["MIT"]), ("License: GPLv3", ["GPL-3.0"]),
        ("Licensed under the Apache License Version 2", ["Apache-2.0"]), ("SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0"]), ("// SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
        ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]), ("Released under the Eclipse Public License 2.0", ["EPL-2.0"]),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT", "Apache-2.0"]), ("SPDX-License-Identifier: MIT AND ISC OR Zlib", ["MIT", "ISC", "Zlib"]), ("SPDX-License-Identifier: MIT OR else", ["MIT"]),
        ("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007", ["GPL-3.0"]),
        (licenses.FAMILY_ONLY.format("program", "", "2"), ["GPL-2.0"]), (licenses.FAMILY.format("program", "", "1"), []), (licenses.FAMILY.format("program", "Lesser ", "2"), []),
    ],
)
def test_probes(text, kinds):
    assert [f[2] for f in SCANNER.find(text)] == kinds


def test_compression_ranks_what_wording_alone_leaves_open():
    """A notice of four clauses words those of two and three as well; the template that saves most bytes is taken."""
    four = dict(licenses.notices())["BSD-4-Clause"]
    assert [f[2:] for f in SCANNER.find(four)] == [("BSD-4-Clause", 0, 0)]
    blind = licenses.Scanner(-9.0, 20, 0.1)
    blind.given = [blind.alone] * len(blind.given)
    assert [f[2] for f in blind.find(four)] != ["BSD-4-Clause"]
    strict = licenses.Scanner(9.0, 20, 0.1)
    assert strict.find(four) == []


def test_query_against_every_template_at_every_word(spark):
    """Each span words a template of its license as it says, and every place that words a template is in or beside a span."""
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    exact, n = {}, 0
    for kind, w in SCANNER.known:
        exact.setdefault((w[0], len(w)), []).append((kind, w))
    for r in licenses.op3_license_scan(spark, sf).collect():
        text = texts[r.doc_id]
        spans = [x.rsplit(":", 4) for x in r.spans.split(",")] if r.spans else []
        spans = [(k, int(a), int(b), int(m), int(e)) for k, a, b, m, e in spans]
        n += len(spans)
        for kind, a, b, missing, extra in spans:
            mine = licenses.words(text[a:b])
            assert any((missing, extra) == licenses.wording(w, mine)[:2] for k, w in SCANNER.known if k == kind) or mine == [kind.lower()]
        found = [(m.span(), m.group().lower()) for m in licenses._WORD.finditer(text)]
        mine = [w for _, w in found]
        for i, w in enumerate(mine):
            for (first, size), known in exact.items():
                if w == first and any(mine[i : i + size] == t for _, t in known):
                    a, b = found[i][0][0], found[i + size - 1][0][1]
                    assert licenses._BLANK.search(text, a, b) or any(x < b and a < y for _, x, y, *_ in spans), (r.doc_id, text[a:b])
    assert n > 20
