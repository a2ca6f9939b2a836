"""op2 and op9 against the tokenizers library."""

import hashlib
import random
import struct
import time
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimforge.llm import bpe, pretokens, token_files

from .conftest import AWKWARD

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PATTERN = regex.compile(public_tokenizers.PATTERN)
texts = st.lists(st.text(st.sampled_from("ab  \n\t'sreveld5²é　.!-\U0001f600"), max_size=30), min_size=1, max_size=6)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts)
def test_pretokens_follow_the_pattern(many):
    data = np.frombuffer("".join(many).encode(), np.uint8)
    points = pretokens.code_points(data)
    begins = np.cumsum([0, *map(len, many)])[:-1]
    begins = begins[begins < len(points)]
    first = pretokens.starts(points, begins)
    cut = [*first.tolist(), len(points)]
    assert ["".join(map(chr, points[a:b])) for a, b in zip(cut, cut[1:])] == [w for t in many for w in PATTERN.findall(t)]


@settings(max_examples=100, deadline=None)
@given(texts, st.sampled_from([1, 1 << 20]))
def test_encoding_is_the_library_s(many, chunk):
    got = []
    for _, _, ids, to in token_files.encode_column(pa.array(many, pa.string()), PATH, None, chunk):
        got += [ids[a:b].tolist() for a, b in zip(to, to[1:])]
    assert got == [ids_of(t) for t in many]


def test_lexicon_holds_what_was_put_in():
    merges = bpe.Merges(PATH)
    words = [b" the", b"the", b"then", b" then", b"x", "é".encode(), b" running", b"ing"]
    lexicon = bpe.Lexicon.compile((w, merges.ids(w)) for w in words)
    asked = [*words, b"th", b"thenn", b" ", b"zzz"]
    size = np.array([len(w) for w in asked])
    rows = lexicon.rows(np.frombuffer(b"".join(asked), np.uint8), np.cumsum(size) - size, size).tolist()
    assert rows[len(words) :] == [-1] * 4
    for w, r in zip(words, rows):
        assert lexicon.table[lexicon.bounds[r] : lexicon.bounds[r + 1]].tolist() == ids_of(w.decode())
    assert len(lexicon.final) < sum(map(len, words))  # prefixes and suffixes are shared


def test_merging_is_the_library_s():
    merges = bpe.Merges(PATH)
    for word in (" internationalization", "aaaaaaaaaaaaaaa", "éééé", "\n\n\n", "-----", " 12345678", "thontionhableer"):
        assert merges.ids(word.encode()) == ids_of(word)


@pytest.mark.parametrize("most_words", [1, 300_000])
def test_round_trip(awkward, most_words):
    out = bpe.bpe_round_trip(awkward, PATH, lexicon_words=50, most_words=most_words, chunk_bytes=64, with_ids=True).collect()
    want = Counter()
    for i, t in AWKWARD:
        ids = ids_of(t)
        assert LIBRARY.decode(ids, skip_special_tokens=False) == (t or "")
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:4] for r in out) == want
    assert all(r.n_tokens == len(r.ids) for r in out)


def test_token_files(awkward):
    shards, folder = token_files.write_shards(awkward, PATH, shards=3)
    out = sorted(token_files.read_shards(shards, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted((i for i, _ in AWKWARD), key=lambda i: (i is not None, i))
    start, want = 0, Counter()
    for r in out:
        assert r.start == start
        start += r.n_tokens
    for i, t in AWKWARD:
        ids = [*ids_of(t), 2]
        want[i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want
    first = shards.orderBy("shard").first()
    import pyarrow.fs as pafs

    shard = token_files.Shard(pafs.FileSystem.from_uri(folder)[0], first.path)
    k = shard.numbers.index(4) if 4 in shard.numbers else 0
    assert shard.ids(k).tolist()[-1] == 2  # one document by its own bytes


def test_no_documents(nothing):
    assert bpe.bpe_round_trip(nothing, PATH).count() == 0
    assert token_files.read_shards(*token_files.write_shards(nothing, PATH)).count() == 0


def test_merging_side_by_side():
    merges, rng = bpe.Merges(PATH), random.Random(1)
    words = ["".join(rng.choice("abcdeetioanrsé .,!'ss  aaa12") for _ in range(rng.randint(1, 100))).encode() for _ in range(1_000)]
    words += [b"a" * k for k in range(1, 70)] + ["²é".encode() * 9, b"\xff\xc3"]
    assert merges.ids_of_all(words) == merges.ids_of_all(words, 0)
    assert merges.ids_of_all([]) == [] and merges.ids_of_all([b""]) == [b""]


def test_a_word_of_many_letters():
    rng = random.Random(2)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    begin = time.monotonic()
    got = bpe.Merges(PATH).ids(word.encode())
    assert time.monotonic() - begin < 30
    assert got == LIBRARY.encode(word, add_special_tokens=False).ids


def test_several_special_strings():
    special = {"<b>": 2, "<a>": 1, "<a><": 3}
    text = "x<a>y<b>z<a><b>".encode()
    got, to = pretokens.encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]), special, lambda ws: [bytes([w[0], 0, 0, 0]) for w in ws])
    assert got.tolist() == [ord("x"), 1, ord("y"), 2, ord("z"), 3, ord("b"), ord(">")] and to.tolist() == [0, 8]


def test_counted_pre_tokens():
    many = ["it's a cat, a cat", "", "a cat  ²é"]
    ends = np.append(0, np.cumsum([len(t.encode()) for t in many]))
    words, n = pretokens.counted(np.frombuffer("".join(many).encode(), np.uint8), ends)
    assert Counter(dict(zip(words, n))) == Counter(w.encode() for t in many for w in PATTERN.findall(t))


def test_pieces_for_the_dictionary_are_spread():
    assert token_files._spread(0, 10, 4) == [] and token_files._spread(35, 10, 4) == [0, 10, 20, 30]
    assert token_files._spread(1_000, 10, 4) == [0, 330, 660, 990]


def test_tables_of_words_are_bounded_in_bytes():
    """Words that are long are encoded and forgotten; results stay the same when the tables are emptied."""
    import random

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([3, 5, 400]))).encode() for _ in range(300)]
    words = list(dict.fromkeys(words))
    encoder = bpe.Encoder(PATH, None, 50)
    want = [array("i", ids_of(w.decode())).tobytes() for w in words]
    for part in (words[:100], words, words[50:]):
        got = encoder.ids_of(part)
        assert got == [want[words.index(w)] for w in part]
        assert all(len(w) <= bpe.SHORT for w in encoder.known)
    token_files._known(PATH).clear()
    for part in (words[:100], words, words[50:]):
        assert token_files._ids_of(PATH, 50, part) == [want[words.index(w)] for w in part]
        assert all(len(w) <= token_files._SHORT for w in token_files._known(PATH))


def test_batches_of_large_values_are_cut_by_bytes():
    import pyarrow as pa

    from claimforge.llm import exact_dedup

    schema = pa.schema([("a", pa.int32()), ("content", pa.binary())])
    rows = [(i, b"x" * 1000) for i in range(1000)] + [(0, b"y" * 9000)]
    made = list(exact_dedup._batches(iter(rows), schema, most_bytes=4000))
    assert sum(b.num_rows for b in made) == len(rows) and max(b.num_rows for b in made) == 4
