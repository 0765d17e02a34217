"""Byte-level BPE against the libraries whose result it must give, and round trips."""

import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import example, given, settings
from hypothesis import strategies as st

from playtrack.llm import byte_bpe, queries


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(byte_bpe.vocabulary_path(byte_bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def model():
    return byte_bpe.byte_bpe()


def ids_of(model, texts):
    return [np.frombuffer(x, "<i4").tolist() for x in model.encode(texts)]


ODD = ["", " ", "  ", "\n", "a\n", " a", "a  b", "a \n b", "x  y", "   a", "a\x0b b", "it's I'LL we've ''s", "aaa aaaa aaaaa",
       "<|endoftext|> a <|startoftext|>", "héé ſ İ ÀÉ", "漢字かな交じり文", "👩‍👩‍👧 🇫🇷 🏳️‍🌈", "\0 \x1c\x1f\x7f \x85 ok", "é ́́", "1234567 12.5, 7.",
       "a.,b.. c,, . , -. .-", "word. word, word.\nword,\r\nword.\tword", "a" * 5000, " " * 3000, "퟿�\U0010ffff", "<b>x</b>." * 50]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet=" \n\t\r\x0b ab.,'s1é漢👩", max_size=40)), max_size=5))
@example(ODD)
def test_ids_equal_the_library(model, library, texts):
    assert ids_of(model, texts) == [library.encode_ordinary(t) for t in texts]
    assert [model.decode(np.array(x, int)).decode() for x in ids_of(model, texts)] == texts


def test_small_and_full_caches_give_the_same(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 8)
    monkeypatch.setattr(byte_bpe, "LONGEST", 3)
    model = byte_bpe.ByteBpe(byte_bpe.vocabulary_path(byte_bpe.RANKS), byte_bpe.default_pattern())
    texts = ["one two. three, one two three four", "two. one", None, "four three, five six seven. eight nine ten"] * 3
    for _ in range(3):
        assert ids_of(model, texts) == [library.encode_ordinary(t or "") for t in texts]


@pytest.mark.parametrize("space", [chr(c) for c in range(0x3001) if chr(c).isspace()])
def test_every_white_space_beside_every_other(model, library, space):
    texts = [f"a{space}{x}b {space}{x}{space}.{x}{space} c{x}{space}" for x in (" ", "\n", "\t", "\r", "\x0b", "\xa0", "\u3000", "\x1c", "")]
    assert ids_of(model, texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="a 👩漢é\n.", max_size=30)))
@example("x 👩‍👩‍👧漢字é")
def test_offsets_equal_the_library(model, text):
    ids = np.array(ids_of(model, [text])[0], np.int64)
    starts, ends = model.offsets(text.encode(), ids)
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == model.tokenizer.encode(text).offsets


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="a 👩漢é\n.", max_size=30), st.lists(st.integers(0, 60), max_size=6))
def test_slices_that_cut_characters_decode_to_the_text(model, text, cuts):
    ids = np.array(ids_of(model, [text])[0], np.int64)
    bounds = [0, *sorted(min(c, len(ids)) for c in cuts), len(ids)]
    decoder = byte_bpe.SliceDecoder(model)
    parts = [decoder.feed(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert "".join(parts) + decoder.feed(ids[:0], True) == text


def test_unknown_ids_and_split_characters(model, spark, library):
    ids = library.encode_ordinary("👩")
    assert len(ids) > 1
    rows = spark.createDataFrame([(1, ids, "x"), (2, ids[1:], "y"), (3, [64, 50256, 10**6, -5, None], "z"), (4, None, "w"), (5, [], "v")],
                                 "doc_id long, ids array<int>, data string")
    got = {r["doc_id"]: r["data"] for r in byte_bpe.decode(rows, text=True).collect()}
    assert got[1] == "👩" and set(got[2]) == {"�"} and got[3] == "a" + 4 * "�" and got[4] == got[5] == ""
    assert byte_bpe.decode(rows).columns == ["doc_id", "ids", "data"]


def test_odd_rows(odd_docs, no_docs, library):
    got = byte_bpe.encode(odd_docs, offsets=True).collect()
    want = [(r["doc_id"], library.encode_ordinary(r["text"] or "")) for r in odd_docs.collect()]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == sorted(want, key=str)
    assert all(len(r["ids"]) == len(r["starts"]) == len(r["ends"]) for r in got)
    assert byte_bpe.decode(byte_bpe.encode(no_docs)).count() == 0


def test_query_over_the_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in queries.op12_byte_bpe(spark, sf).collect()) == sorted(want)
