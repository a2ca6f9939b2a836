"""op1, op3 and op7."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimforge.llm import languages, licenses, secrets
from claimforge.llm.pretokens import mix

SCANNER = secrets.Scanner((*secrets.BASE_RULES, *secrets.MORE_RULES))
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PARTS = ["password", "PassWd", "secret", "token", "api_key", "apikey", '"', "'", " ", ":", "=", "abcdefgh", "12", "AKIA", "ABCDEF0123456789", "0123456789abcdef" * 2, "x", "-", "\n", "é"]


def brute(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_base_rules(parts):
    text = "".join(parts)
    data = text.encode()
    got = [(len(data[:a].decode()), k, len(data[:b].decode())) for a, k, b in SCANNER.spans(data) if k < 3]
    assert got == brute(text)


def test_more_rules():
    text = "ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890-abc"
    assert [SCANNER.rules[k].kind for _, k, _ in SCANNER.spans(text.encode())] == ["github", "private_key", "slack"]


def test_secret_table(documents, nothing):
    docs = documents([(1, None), (2, ""), (3, "é password=abcdefgh1"), (3, "é password=abcdefgh1"), (None, "AKIA" + "A" * 16), (4, "x" * 100_000)])
    out = secrets.scan_secrets(docs).collect()
    assert sorted(r.spans for r in out) == ["", "", "", "access:0:20", "assign:2:20", "assign:2:20"]
    assert secrets.scan_secrets(nothing).count() == 0


def test_secret_query_against_brute_force(spark):
    """Every row and span of the table, by Python's own regular expressions."""
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in secrets.op1_secret_scan(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    names = [r.kind for r in secrets.BASE_RULES]
    more = [(r.kind, re.compile(r.pattern), r.least) for r in secrets.MORE_RULES]
    for d in docs:
        text, r = d.text or "", rows[d.doc_id]
        base = brute(text)
        joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        others = [(m.start(), 3 + j, m.end()) for j, (_, p, least) in enumerate(more) for m in p.finditer(text) if len(m[0]) >= least]
        kinds = names + [k for k, _, _ in more]
        assert r.spans == ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(base + others))


def test_places_of_many_spans_in_one_long_text(documents):
    line = "é password=abcdefgh1\n"
    r = secrets.scan_secrets(documents([(1, line * 20_000)])).first()
    assert r.n_assign == 20_000 and r.spans.endswith(f"assign:{19_999 * len(line) + 2}:{20_000 * len(line) - 1}")


def test_licenses(documents, nothing):
    mit = licenses.NOTICES["MIT"].replace(". ", ".\n")
    docs = documents(
        [
            (1, None), (2, ""), (3, "x\nReleased under the MIT License.\ny"), (4, "Licensed under CC BY-NC 4.0."), (5, f"head\n{mit}\n\ntail"), (None, "SPDX-License-Identifier: Apache-2.0"),
            (6, "My driving license is new, and permission to use the road is mine."), (7, "This work is licensed under the GNU General Public License, version 3."), (7, "plain " * 20_000),
        ]
    )
    out = licenses.scan_licenses(docs).collect()
    assert sorted((r.doc_id or 0, r.licenses) for r in out) == [
        (0, "Apache-2.0"), (1, ""), (2, ""), (3, "MIT"), (4, "CC-BY-NC-4.0"), (5, "MIT"), (6, ""), (7, ""), (7, "GPL-3.0"),
    ]
    assert licenses.scan_licenses(nothing).count() == 0


def test_every_statement_is_found():
    scanner = licenses.Scanner(0.2, 20, 0.1)
    for kind, template in licenses.templates():
        found = scanner.find(f"Before it.\n{template}\nAfter it.")
        assert [f[2] for f in found] == [kind], template


def test_languages(spark, documents, nothing):
    english = [(i, "the cat and the dog were there with them " * 3 + str(i)) for i in range(30)]
    german = [(100 + i, "der hund und die katze waren nicht mit ihnen " * 3 + str(i)) for i in range(30)]
    docs = documents(english).union(documents(german, "de"))
    model = languages.train(docs, ~languages.held_out(), "doc_id", "text", "lang")
    odd = documents([(1, None), (2, ""), (3, "123 !!"), (4, "the dog and the cat"), (None, "die katze und der hund"), (5, "the " * 40_000), (5, "the " * 40_000)])
    got = languages.identify_languages(odd, model).collect()
    named = sorted(((r.doc_id or 0), r.lang_pred) for r in got)
    assert named == [(0, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "en"), (5, "en")]
    assert all(0 <= r.score <= 1 for r in got) and got[0].id == "x"
    assert languages.identify_languages(nothing, model).count() == 0
    assert languages.train(nothing, ~languages.held_out(), "doc_id", "text", "lang") is None
    assert {r.lang_pred for r in languages.identify_languages(odd, None).collect()} == {"und"}


@pytest.mark.parametrize("n", [2, 4, 5, 9])
def test_codewords_differ(n):
    code = languages.codewords(n)
    assert len({tuple(c) for c in code}) == n


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    out = languages.op7_language_id(spark, "/root/testdata/sf0.001").where("held_out").join(labels, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in out) >= 0.95 * len(out)


def grams(text: str, bits: int = 15) -> list[int]:
    """Hashed two- and three-byte grams of a text, letter by letter."""
    fold = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()]
    codes = [(fold[i] * 257 + fold[i + 1]) + (2 << 40) for i in range(len(fold) - 1)]
    codes += [((fold[i] * 257 + fold[i + 1]) * 257 + fold[i + 2]) + (3 << 40) for i in range(len(fold) - 2)]
    return (mix(np.array(codes, np.uint64)) >> np.uint64(64 - bits)).tolist()


def test_language_query_against_a_plain_model(spark):
    """The same classifiers and decoding with dictionaries and loops, for every row of the table."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts = defaultdict(Counter)
    for d in docs:
        if d.lang is not None and d.text is not None and zlib.crc32(str(d.doc_id).encode()) % 4 != 2:
            counts[d.lang].update(grams(d.text))
    langs, size = sorted(counts), 1 << 15
    code = languages.codewords(len(langs)).tolist()
    share = [lambda f, c=counts[x], n=sum(counts[x].values()) + size / 2: (c[f] + 0.5) / n for x in langs]

    def weight(f, b, known={}):  # noqa: B006
        if (f, b) not in known:
            side = lambda sign: [share[k](f) for k in range(len(langs)) if code[k][b] == sign]
            yes, no = side(1), side(-1)
            known[f, b] = math.log(sum(yes) / len(yes)) - math.log(sum(no) / len(no))
        return known[f, b]

    bits = range(len(code[0]))
    margin = lambda c, b: sum(n * weight(f, b) for f, n in c.items()) / max(sum(c.values()), 1)
    trust = [1 / (1 + math.exp(-8 * min(margin(counts[x], b) * code[k][b] for k, x in enumerate(langs)))) for b in bits]
    got = {r.doc_id: r for r in languages.op7_language_id(spark, sf).collect()}
    for d in docs:
        r = got[d.doc_id]
        if not any(c.isalpha() for c in d.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        m = [margin(Counter(grams(d.text)), b) for b in bits]
        loss = [sum(trust[b] * math.exp(-2 * m[b] * code[k][b]) for b in bits) / len(bits) for k in range(len(langs))]
        parts = [math.exp(-x) for x in loss]
        best = max(range(len(langs)), key=parts.__getitem__)
        assert r.lang_pred == langs[best] and abs(r.score - parts[best] / sum(parts)) < 1e-4
