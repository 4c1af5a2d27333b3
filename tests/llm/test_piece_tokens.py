"""Ids and texts against the library."""

import hashlib
import random
from array import array

import pytest

from sheetstar.llm import piece_tokens, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    return piece_tokens.PrefixEncoder(piece_tokens.public_model())


@pytest.fixture(scope="module")
def library(encoder):
    return encoder.pieces.model


def ids(encoder, text):
    return array("i", encoder.encode(text)).tolist()


def test_random_mixtures(encoder, library):
    rng = random.Random(1)
    parts = ["a", "b", "t", "h", "e", " ", "  ", "   ", "\n", "é", "中", "▁", "1", "2", "!", "in", "ing", " the", "_", "\t", "\x00", "😀", "ﬁ", "-", "--", "==", "\r\n", "</s>", "<0x41>", "²", "’", "”.", "и"]
    for _ in range(6_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert ids(encoder, text) == library.encode(text), text


def test_texts_of_pieces(encoder, library):
    rng = random.Random(2)
    pieces = list(encoder.pieces.ids)
    for _ in range(6_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 6))).replace("▁", " ")
        assert ids(encoder, text) == library.encode(text), text


def test_runs_of_spaces_and_long_words(encoder, library):
    for n in range(70):
        for text in (" " * n, " " * n + "x", "x" + " " * n, " " * n + "\n" + " " * n):
            assert ids(encoder, text) == library.encode(text), text
    for text in ("a" * 5_000, "ab" * 3_000, "中文" * 2_000, "=" * 5_000, "thththe" * 700):
        assert ids(encoder, text) == library.encode(text)


def test_every_prefix_has_one_last_token(encoder, library):
    """The table holds the last token of each prefix, and no other token that ends there fits."""
    rng = random.Random(4)
    for _ in range(200):
        text = "▁" + "".join(rng.choice("theraning▁") for _ in range(rng.randrange(1, 14)))
        last = encoder.last_tokens(text)
        for end in range(1, len(text) + 1):
            assert last[end] == encoder.pieces.merged(text[:end])[0][-1]
            fitting = [
                token for stop, (length, token) in encoder.automaton.iter(text)
                if stop + 1 == end and (length == end or encoder.pieces.fit(last[end - length], token))
            ]
            assert fitting == [last[end]]


def test_fit_is_that_of_merges(encoder):
    """The pair test against merging the joined text."""
    rng = random.Random(5)
    whole, fit = encoder.pieces.whole, 0
    for _ in range(20_000):
        a, b = rng.choice(whole), rng.choice(whole)
        expected = encoder.pieces.merged(encoder.pieces.text[a] + encoder.pieces.text[b])[0] == [a, b]
        assert encoder.pieces.fit(a, b) == expected
        fit += expected
    assert 0 < fit < 20_000


def test_a_worker_that_remembers_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(piece_tokens, "REMEMBERED", 0)
    monkeypatch.setattr(piece_tokens, "REMEMBERED_PAIRS", 1)
    text = "It was the best of times, it was the worst of times.\n" * 3
    assert ids(encoder, text) == library.encode(text)


def test_decoding(encoder, library):
    decoder = piece_tokens.PieceDecoder(piece_tokens.public_model())
    rng = random.Random(6)
    space = encoder.pieces.ids["▁"]
    for _ in range(6_000):
        some = [rng.choice([rng.randrange(32_000), rng.randrange(259), rng.randrange(3, 259), space, 0, 1, 2]) for _ in range(rng.randrange(12))]
        assert decoder.decode(some) == library.decode(some), some


def test_whole_given_table(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc, text in rows:
        coded = library.encode(text or "")
        want.append((doc, len(coded), sha(",".join(map(str, coded))), sha(library.decode(coded))))
    assert sorted(map(tuple, queries.op12_prefix_pieces(spark, SF).collect())) == sorted(want)


def test_odd_rows(spark, library):
    texts = [None, "", " ", "\n", "a " * 60_000, "x" * 60_000, "same", "same", "\u0000é😀"]
    df = spark.createDataFrame([(None if i == 3 else i, t, "x", [1]) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string, ids array<int>")
    coded = piece_tokens.encode(df, piece_tokens.public_model())
    assert {r.doc_id: r.ids for r in coded.collect()} == {None if i == 3 else i: library.encode(t or "") for i, t in enumerate(texts)}
    back = piece_tokens.decode(coded, piece_tokens.public_model())
    assert {r.doc_id: r.text for r in back.collect()} == {None if i == 3 else i: t or "" for i, t in enumerate(texts)}
    assert piece_tokens.digests(df.limit(0), piece_tokens.public_model()).collect() == []


def test_lists_of_ids_are_read_from_their_offsets():
    """Slices, null and empty lists too."""
    import pyarrow as pa

    column = pa.array([[9, 9], [1, 2, 3], None, [], [4]], pa.list_(pa.int32()))
    assert list(piece_tokens._lists(column.slice(1))) == [[1, 2, 3], [], [], [4]]
    assert all(type(i) is int for ids in piece_tokens._lists(column) for i in ids)
    assert list(piece_tokens._lists(column.slice(0, 0))) == []
