import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheetstar.llm import token_files
from sheetstar.llm.common import Scratch

SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=600))
def test_round_trip(values):
    words, escapes = token_files.pack(np.array(values, dtype=np.uint64))
    assert token_files.unpack(words, escapes).tolist() == values


def test_runs_are_packed_tightly():
    words, escapes = token_files.pack(np.zeros(240 * 50, dtype=np.uint64))
    assert len(words) == 8 * 50 and escapes == b""


def test_escapes_keep_whole_numbers():
    values = [1, token_files.ESCAPE - 1, token_files.ESCAPE, 2**64 - 1, 7]
    words, escapes = token_files.pack(np.array(values, dtype=np.uint64))
    assert len(escapes) == 16 and token_files.unpack(words, escapes).tolist() == values


def direct(texts):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(token_files.public_tokenizer())
    return [made.encode(t or "", add_special_tokens=False).ids + [token_files.END_ID] for t in texts]


AWKWARD = ["", " ", "\n\n x", "it's they'll I'D", "a  b   c \t d ", "x²3 ½a _a_ a_b", "Ünï cöde — ß €5", "日本語 text", "a<|endoftext|>b", "end ", "a b  c", "tab\tword,word;", "'s 're it 's", "é1é", "ſḰx"]


@pytest.mark.parametrize("remembered", [0, 5, 400_000])
def test_pieces_give_the_tokenizers_ids(monkeypatch, remembered):
    monkeypatch.setattr(token_files, "REMEMBERED", remembered)
    encoder = token_files.TextEncoder(token_files.public_tokenizer())
    texts = AWKWARD * 2 + [" ".join(AWKWARD)]
    assert [np.frombuffer(encoder.encode(t), dtype="<u4").tolist() + [2] for t in texts] == direct(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'st \n\t.,1²éÿĀ_-!ʼ "), max_size=30))
def test_pieces_on_random_texts(text):
    encoder = token_files.TextEncoder(token_files.public_tokenizer())
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == direct([text])[0][:-1]


@pytest.fixture(scope="module")
def encoder():
    return token_files.TextEncoder(token_files.public_tokenizer())


def parted(ids, counts):
    return [one.tolist() for one in np.split(ids, np.cumsum(counts)[:-1])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("ab'sl12 \n\t\v\x1c\x85\xa0.,×é½Ā_日"), max_size=20), st.just("a <|endoftext|> b")), min_size=1, max_size=8))
def test_texts_encoded_together_are_as_alone(encoder, texts):
    got = parted(*encoder.encode_all(pa.array(["x", None, *texts, "y"]).slice(2, len(texts))))
    assert got == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_new_piece_is_encoded_once_for_many_texts(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 0)
    encoder, encoded = token_files.TextEncoder(token_files.public_tokenizer()), []
    piece = encoder._piece
    monkeypatch.setattr(encoder, "_piece", lambda p: encoded.append(p) or piece(p))
    texts = [f"wordless thing {i % 10}" for i in range(500)]
    assert parted(*encoder.encode_all(pa.array(texts))) == [ids[:-1] for ids in direct(texts[:10])] * 50
    assert len(encoded) == 12


def test_numbers_and_punctuation_are_pieces_of_their_own():
    encoder = token_files.TextEncoder(token_files.public_tokenizer())
    encoder.encode("call 42.144.35 or,  then\n| wait 'll x'll\n\nend")
    assert set(encoder.known) == {b"call", b" 42", b".", b"144", b"35", b" or", b",", b" ", b" then", b"\n", b"|", b" wait", b" 'll", b" x", b"'ll", b"end"}


def test_long_pieces_are_not_remembered(encoder):
    encoder.encode("日本語" * 100)
    assert max(map(len, encoder.known), default=0) <= token_files.REMEMBERED_BYTES


def test_parts_of_a_batch_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_BYTES", 10)
    texts = ["abc", None, "x" * 25, "", "abcdef", "é" * 4, None]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(7), "text": texts})
    parts = [p.column("text").to_pylist() for p in token_files._parts(batch)]
    assert sum(parts, []) == texts and len(parts) > 1
    assert all(sum(len((t or "").encode()) for t in p[:-1]) <= 10 for p in parts)
    assert list(token_files._parts(batch.slice(0, 0))) == []


def expected(rows):
    out, start = [], 0
    for (doc, _), ids in zip(rows, direct([t for _, t in rows])):
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4"))))
        start += len(ids)
    return out


def test_documents_in_order_and_whole(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    folder = Scratch(spark, "t").path("ids")
    token_files.write(documents, folder, token_files.public_tokenizer(), block_ids=500)
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    assert sorted(map(tuple, token_files.digests(spark, folder).collect())) == expected(rows)
    ids = {r.doc_id: r.ids for r in token_files.tokens(spark, folder).collect()}
    assert [ids[d] for d, _ in rows] == direct([t for _, t in rows])


def test_edge_cases(spark):
    rows = [(5, None), (5, None), (2, ""), (None, "x"), (9, "word " * 200_000)]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id bigint, text string, start int, part string")
    folder = Scratch(spark, "t").path("ids")
    token_files.write(df, folder, token_files.public_tokenizer())
    got = sorted(map(tuple, token_files.digests(spark, folder).collect()), key=lambda r: r[1])
    assert got == expected([(None, "x"), (2, ""), (5, None), (5, None), (9, "word " * 200_000)])
    folder = Scratch(spark, "t").path("ids")
    token_files.write(df.limit(0), folder, token_files.public_tokenizer())
    assert token_files.digests(spark, folder).collect() == []
