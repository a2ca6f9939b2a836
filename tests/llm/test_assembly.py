"""op5 and op6: round trips."""

import gzip
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.fs as pafs
from hypothesis import given, settings
from hypothesis import strategies as st

from claimforge.llm import chats, warc
from claimforge.session import shared_folder

ODD = st.text(st.sampled_from("ab\\<>|[]/\nsé"), max_size=12)
PIECES = st.lists(st.sampled_from([*chats.CONTROL, "\\", "\\\\", "n", "a", "\n", "<", "é"]), max_size=8).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.one_of(ODD, PIECES))
def test_escape_is_reversible(text):
    assert chats.unescape(chats.escape(text)) == text
    assert not chats._CONTROL.search(chats.escape(text))
    assert chats.unescape(chats.escape(text, role=True), role=True) == text and "\n" not in chats.escape(text, role=True)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", ""]), PIECES), max_size=6))
def test_assembly(turns):
    made, begin, end = chats.assemble([r for r, _ in turns], pa.array([t for _, t in turns], pa.string()))
    rows = made.to_pylist()
    assert rows == [f"{chats.START}{chats.escape(r, True)}\n{chats.escape(t)}{chats.END}" for r, t in turns]
    assert [chats.unescape(x.encode()[a:b].decode()) for x, a, b in zip(rows, begin, end)] == [t for _, t in turns]


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a</s>b"), (1, 1, "assistant", "a</s>b"), (2, 5, "assistant", None), (2, None, None, "x\\y"), (None, 1, "user", ""), (3, 2, "ro\nle", "z" * 100_000),
    (3, 1, "assistant", chats.PLANTED), (4, 0, "system", "é"),
]


def test_digests_agree_with_sql(spark):
    turns = spark.createDataFrame([(*t, "extra") for t in TURNS], "conv_id long, turn long, role string, text string, place string").repartition(3)
    formatted = chats.format_conversations(turns, shared_folder(spark, "chats"), shards=3)
    got = Counter(map(tuple, chats.conversation_digests(formatted).collect()))
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", TURNS)
    assert got == Counter(r for r in con.sql(chats.OP5_SQL).fetchall() if r[0] != -1)
    none = chats.format_conversations(turns.limit(0), shared_folder(spark, "chats"))
    assert chats.conversation_digests(none).count() == 0


PAGES = [(1, "http://a/x?y=1", "<p>é</p>"), (2, "http://a/y", "<p>é</p>"), (3, None, None), (4, "http://b c/\n", ""), (5, "http://[bad", "x" * 200_000), (None, "u", "<p>é</p>"), (6, "v", "own")]


def test_archives(spark):
    pages = spark.createDataFrame([(*p, "k") for p in PAGES], "page_id long, url string, html string, payload_key string").repartition(3)
    for rows in (200_000, 0):
        files, folder = warc.write_archives(pages, broadcast_rows=rows, file_bytes=500)
        got = {r.page_id: tuple(r) for r in warc.capture_table(files, folder).collect()}
        assert got[2][3:] == ("response", None) and got[1][3:] == ("revisit", 2) and got[None][3:] == ("revisit", 2)
        assert got[3][3:] == ("revisit", 4) and got[3][1] == 0 and got[1][1] == len("<p>é</p>".encode())
        assert got[5][2] == warc.digest(b"x" * 200_000) and len(got) == len(PAGES)
    nested = warc.transactions(warc.read_archives(files, folder, with_payload=True)).where("metadata.page_id = 5").first()
    assert bytes(nested.answer.payload) == b"x" * 200_000 and nested.request.request_line.startswith("GET ")


def test_least_bytes_and_repeats(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (2, "u", "aa"), (3, "u", "a"), (4, "u", "a")], "page_id long, url string, html string")
    out = Counter((r.page_id, r.record_type) for r in warc.capture_table(*warc.write_archives(pages, least_bytes=2)).collect())
    assert out == Counter({(1, "revisit"): 1, (2, "response"): 2, (3, "response"): 1, (4, "response"): 1})
    assert warc.capture_table(*warc.write_archives(pages.limit(0))).count() == 0


def test_revisits_name_the_record_of_their_response(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    files, folder = warc.write_archives(pages)
    rows = warc.read_archives(files, folder).collect()
    page_of = {r.concurrent_to: r.page_id for r in rows if r.type == "metadata"}
    refers = {page_of[r.record_id]: page_of[r.refers_to] for r in rows if r.type == "revisit"}
    assert refers == {1: 2, None: 2, 3: 4}
    assert len({r.record_id for r in rows}) == len(rows)
    # What the header says holds, not the digest.
    fs, _ = pafs.FileSystem.from_uri(folder)
    raw = b"".join(gzip.decompress(fs.open_input_stream(f.path, compression=None).read()) for f in files.collect())
    assert raw.count(b"WARC-Refers-To: <urn:uuid:") == 3
