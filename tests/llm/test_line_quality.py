"""op12: figures and verdicts against a brute-force version and SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from claimforge.llm import line_quality

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    plain = "".join("0" if c in "0123456789" else c.lower() if "A" <= c <= "Z" else c for c in line)
    return " ".join(WORD.findall(plain))


def brute(rows, most_docs, least_percent=30):
    """Rows of (id, text, host) to the columns of ``judge_lines`` and the cleaned text."""
    texts, ids = defaultdict(set), defaultdict(list)
    lines_of = lambda t: [x for x in (t or "").split("\n") if x.strip(SPACE)]
    for i, t, host in rows:
        for x in lines_of(t):
            texts[host, normal(x)].add(t)
            ids[host, normal(x)].append(i)
    keeper = {k: min((i for i in ids[k] if i is not None), default=None) for k, v in texts.items() if len(v) > most_docs}
    out = []
    for i, t, host in rows:
        words, lines = WORD.findall(t or ""), lines_of(t)
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        n = Counter(grams)
        covered = {q for k, g in enumerate(grams) if n[g] > 1 for q in range(k, k + 5)}
        gone = [x for x in lines if (host, normal(x)) in keeper and keeper[host, normal(x)] != i]
        left = len(words) - sum(len(WORD.findall(x)) for x in gone)
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        clean = None if t is None else "\n".join(x for x in t.split("\n") if x not in gone)
        out.append((
            i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), failed, left,
            not failed and left >= 10 and 100 * left >= least_percent * len(words), clean,
        ))
    return Counter(out)


def rows_of(seed):
    rng = random.Random(seed)
    lines = ["Share this page NOW", "  share\tthis page now\r", "Call 555 0199 é", "call 111 0000 é", "\x0b", "#*$%&|<> x", "a a a a a a a"]
    rows = []
    for i in range(60):
        own = [" ".join(rng.choice("lorem ipsum dolor sit amet elit sed do".split()) + str(rng.randrange(30)) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(4))]
        text = "\n".join(rng.sample(lines, rng.randrange(4)) + own + rng.sample(lines, rng.randrange(3)))
        rows += [(rng.choice([i, i, i, None]), text, rng.choice(["h", "h", "other", None]))] * rng.choice([1, 1, 1, 5])
    return rows


@pytest.mark.parametrize(("seed", "broadcast_rows"), [(1, 100_000), (2, 0)])
def test_against_brute_force(spark, awkward, seed, broadcast_rows):
    rows = rows_of(seed) + [(r.doc_id, r.text, r.source) for r in awkward.collect()] + [(None, None, None), (900, "x " * 40_000, "h")]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, source string, line string, row int").repartition(5)
    got = line_quality.judge_lines(docs, most_docs=2, clean_text=True, broadcast_rows=broadcast_rows, salts=3)
    assert Counter(map(tuple, got.collect())) == brute(rows, 2)


def test_copies_make_no_line_frequent_and_the_first_document_keeps_one(spark):
    body = " ".join(f"w{i}" for i in range(30))
    copies = [(i, body, "h") for i in range(100)]
    near = [(200 + i, f"{body}\nedit {i}", "near") for i in range(50)]
    docs = spark.createDataFrame(copies + near, "doc_id long, text string, source string")
    kept = {r.doc_id for r in line_quality.judge_lines(docs).where("kept").collect()}
    assert kept == {*range(100), 200}


def test_no_rows(nothing):
    assert line_quality.judge_lines(nothing).count() == 0 and line_quality.judge_lines(nothing, clean_text=True).count() == 0


def test_query_against_sql_without_python(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = con.sql(line_quality.OP12_SQL)
    got = line_quality.op12_line_quality(spark, sf)
    assert Counter(map(tuple, got.select(expected.columns).collect())) == Counter(expected.fetchall())
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().toString())
