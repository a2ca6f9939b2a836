"""A feed file that is read by many tasks, with quoted line feeds, against Python's reader."""

import csv
import io
import random

import pytest

from claimforge.sources import feeds

COLUMNS = [*feeds.REQUIRED, "Note, free"]


def some_rows(n):
    rng = random.Random(n)
    notes = ["plain", "two\nlines", 'a "quoted" word', "\n\nblank lines\n", 'ends with "', ",", "é" * 20, " padded ", "\r\n"]
    return [[f"2024-01-{k % 28 + 1:02}", f"Creditor {k}", "Reno", "NV", f"24-{k}", rng.choice(["Debtor\nInc", "Debtor"]), f"${k}", rng.choice(notes)] for k in range(n)]


def written(path, rows, end="\n", bom=False, blanks=False):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([COLUMNS, *rows[:5]])
    if blanks:
        out.write(end + end)
    csv.writer(out, lineterminator=end).writerows(rows[5:])
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + out.getvalue().encode())


@pytest.mark.parametrize(("end", "bom", "blanks"), [("\n", False, False), ("\r\n", True, True)])
def test_large_file_against_csv_reader(spark, tmp_path, end, bom, blanks):
    parts = {"a.csv": some_rows(400), "b.csv": some_rows(60), "c.csv": []}
    for name, rows in parts.items():
        written(tmp_path / name, rows, end, bom, blanks and bool(rows))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = feeds.read_claim_feed(spark, str(tmp_path))
        got = sorted((r["file"].rpartition("/")[2], r.line_number, *(r[c] or "" for c in COLUMNS)) for r in df.collect())
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    want = []
    for name in parts:
        with open(tmp_path / name, newline="", encoding="utf-8-sig") as f:
            want += [(name, k, *r) for k, r in enumerate(csv.reader(x for x in f), 1) if k > 1 and r]
    # Blank lines are no records, as for a reader of dictionaries.
    want = [(n, k, *r) for n in parts for k, (_, _, *r) in enumerate([w for w in want if w[0] == n], 2)]
    plain = lambda rows: sorted((n, k, *[v.replace("\r\n", "\n") for v in r]) for n, k, *r in rows)
    assert plain(got) == plain(want)


def test_headings(spark, tmp_path):
    (tmp_path / "x.csv").write_text("name,amount\n1,2\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        feeds.read_claim_feed(spark, str(tmp_path))
    written(tmp_path / "x.csv", some_rows(3))
    (tmp_path / "y.csv").write_text(",".join(reversed(feeds.REQUIRED)) + "\n")
    with pytest.raises(ValueError, match="different headings"):
        feeds.read_claim_feed(spark, str(tmp_path))
