"""Token ids in files of Simple-8b blocks: word-aligned, with escapes and per-block offsets."""

from __future__ import annotations

import json
import re
import string
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheetstar.llm.common import release_memory, small_batches

END_ID = 2
#: A block is closed at the first document end after so many ids.
BLOCK_IDS = 65_536
#: Pieces of text whose ids a task remembers; later new pieces are encoded without being remembered.
REMEMBERED = 200_000
#: Longer pieces aren't remembered.
REMEMBERED_BYTES = 64
#: Bytes of texts that are cut and looked up at once, up to one text more.
TEXT_BYTES = 4_000_000
if array("I").itemsize != 4 or sys.byteorder != "little":
    raise ImportError("32-bit little-endian integers are needed")

#: Fixed values of the published coding: how many ids of how many bits a 64-bit word holds, by selector.
SELECTORS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_COUNTS = np.array([c for c, _ in SELECTORS])
#: The payload that stands for the next escaped number.
ESCAPE = (1 << 60) - 1
_LIMITS = np.array([1 << k for k in range(61)], dtype=np.uint64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(words, escapes) of unsigned 64-bit numbers.

    Each word takes the most numbers that fit from where it starts. Numbers from 2**60 - 1 on go to
    the escapes, whole, and leave a mark in a word of their own.
    """
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if n == 0:
        return b"", b""
    escaped = values >= np.uint64(ESCAPE)
    width = np.searchsorted(_LIMITS, values, side="right").astype(np.uint8)
    width[values == 0] = 0
    width[escaped] = 60
    choice = np.full(n, len(SELECTORS) - 1, dtype=np.uint8)
    widest, narrowest = int(width.max()), int(width.min())
    for s in range(len(SELECTORS) - 2, -1, -1):
        count, bits = SELECTORS[s]
        if bits < narrowest or count > n:
            continue
        if bits >= widest:
            choice[: n - count + 1] = s
            continue
        fits = width <= bits
        # A window fits where both its halves do.
        done = 1
        while done < count and len(fits):
            step = min(done, count - done)
            fits = fits[:-step] & fits[step:] if len(fits) > step else fits[:0]
            done += step
        choice[: len(fits)][fits] = s
    steps, at, i = _COUNTS[choice].tolist(), [], 0
    while i < n:
        at.append(i)
        i += steps[i]
    at = np.array(at)
    used = choice[at]
    words = used.astype(np.uint64) << np.uint64(60)
    stored = np.where(escaped, np.uint64(ESCAPE), values)
    for s, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(used == s)
        if bits and len(mine):
            payload = stored[at[mine][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
            words[mine] |= np.bitwise_or.reduce(payload, axis=1)
    return words.astype("<u8").tobytes(), values[escaped].astype("<u8").tobytes()


def unpack(words: bytes, escapes: bytes = b"") -> np.ndarray:
    """The numbers of a block; all words of one selector are decoded together."""
    words = np.frombuffer(words, dtype="<u8")
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selector]
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(selector == s)
        if bits and len(mine):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            out[at[mine][:, None] + np.arange(count)] = (words[mine][:, None] >> shifts) & np.uint64((1 << bits) - 1)
    if escapes:
        out[at[(selector == len(SELECTORS) - 1) & (words & np.uint64(ESCAPE) == np.uint64(ESCAPE))]] = np.frombuffer(escapes, dtype="<u8")
    return out


def public_tokenizer() -> str:
    """The public byte-level vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Kinds of bytes: others, letters (also both bytes of À to ÿ without × and ÷), digits, ASCII punctuation, apostrophes,
#: spaces, and other ASCII white space. Cuts are only made beside characters of known kinds.
_OTHER, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _SPACE, _BLANK = range(7)
_KINDS = np.full(256, _OTHER, dtype=np.uint8)
for _kind, _chars in ((_LETTER, string.ascii_letters), (_DIGIT, string.digits), (_MARK, string.punctuation), (_APOSTROPHE, "'"), (_SPACE, " "), (_BLANK, "\t\n\v\f\r")):
    _KINDS[list(_chars.encode())] = _kind
#: The first byte of À to ÿ, and second bytes that give × and ÷.
_ACCENTED, _SIGNS = 0xC3, (0x97, 0xB7)


def _pairs() -> np.ndarray:
    """What stands between two kinds (8 * left + right): 1 a cut, 2 one if a known non-blank follows the right, 3 one if the
    left is a piece of its own, 0 none.

    The splitting rule of byte-level models always ends a piece before white space, and where letters, digits and punctuation
    meet, except for an apostrophe before letters ('ll). Of white space before something else, the last one is parted
    from those before; a space then begins the next piece, any other is a piece.
    """
    out = np.zeros(64, dtype=np.uint8)
    solid = (_LETTER, _DIGIT, _MARK, _APOSTROPHE)
    for left in solid:
        out[[8 * left + _SPACE, 8 * left + _BLANK]] = 1
        for right in solid:
            same = left == right or {left, right} == {_MARK, _APOSTROPHE}
            out[8 * left + right] = not same and (left, right) != (_APOSTROPHE, _LETTER)
        out[8 * _BLANK + left] = 3
    for left in (_SPACE, _BLANK):
        out[[8 * left + _SPACE, 8 * left + _BLANK]] = 2
    return out


_PAIRS = _pairs()


def _kinds(text: np.ndarray) -> np.ndarray:
    kinds = _KINDS[text]
    lead = np.flatnonzero(text[:-1] == _ACCENTED)
    lead = lead[~np.isin(text[lead + 1], _SIGNS)]
    kinds[lead] = kinds[lead + 1] = _LETTER
    return kinds


def cuts(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces begin in the UTF-8 bytes of texts that begin at ``starts`` (texts without bytes have none): places that no
    token spans, so that pieces are encoded alone as in their text."""
    kinds = _kinds(text)
    first = np.zeros(len(text) + 1, dtype=bool)
    first[starts] = first[-1] = True
    between = _PAIRS[kinds[:-1] << 3 | kinds[1:]]
    begins = first[:-1].copy()
    begins[1:] |= between == 1
    # The last blank of several; what follows it is of the same text.
    last = np.flatnonzero(between == 2) + 1
    last = last[~first[last + 1] & ~first[last]]
    following = kinds[last + 1]
    begins[last[(following >= _LETTER) & (following <= _APOSTROPHE)]] = True
    # Behind a blank that is cut off from what stands before it.
    behind = np.flatnonzero(between == 3) + 1
    begins[behind[begins[behind - 1]]] = True
    return np.flatnonzero(begins)


_ACCENTS = "À-ÖØ-öø-ÿ"
#: Pieces that the splitting rule leaves whole, which the model takes as they are.
_SINGLE = re.compile(rf" ?(?:[A-Za-z{_ACCENTS}]+|[0-9]+|[!-/:-@\[-`{{-~]+)")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level models show each byte as: itself if printable, else the next free one from 256."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class TextEncoder:
    """Ids of texts by a ``tokenizers`` file, as little-endian unsigned 32-bit numbers.

    For byte-level models without normalisation, texts are cut at places no token spans, and each
    distinct piece of many texts is encoded once: most of a text is words met before. Other models, and
    texts that hold an added token, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        splitter, model = made.get("pre_tokenizer") or {}, made["model"]
        self.by_piece = (
            splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
            and not made.get("normalizer") and not made.get("truncation") and not made.get("padding")
            and model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        self.added = [t["content"] for t in made.get("added_tokens", [])]
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        if not _SINGLE.fullmatch(text):
            return self._whole(text)
        # A single word needs no splitting: the model takes it as it is.
        shown = text.replace(" ", self.letters[32]) if len(text) == len(piece) else piece.decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces."""
        known = self.known
        coded = list(map(known.get, pieces))
        if None in coded:
            room = REMEMBERED - len(known)
            for i, ids in enumerate(coded):
                if ids is None:
                    piece = pieces[i]
                    coded[i] = ids = self._piece(piece)
                    if room > 0 and len(piece) <= REMEMBERED_BYTES:
                        known[piece] = ids
                        room -= 1
        return coded

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text]))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), one after another, and how many each has."""
        if not self.by_piece:
            coded = [self._whole(t or "") for t in texts.to_pylist()]
            return np.frombuffer(b"".join(coded), dtype="<u4"), np.array([len(c) // 4 for c in coded], dtype=np.int64)
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        if not pc.sum(pc.binary_length(texts)).as_py():
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts), dtype=np.int64)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = data[int(offsets[0]) : int(offsets[-1])]
        offsets = offsets - offsets[0]
        begins = cuts(np.frombuffer(data, dtype=np.uint8), offsets[:-1][offsets[:-1] < offsets[1:]])
        whole = np.zeros(len(texts), dtype=bool)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if whole.any():
            text = np.searchsorted(offsets, begins, side="right") - 1
            begins = begins[~whole[text] | (begins == offsets[text])]
        bounds = np.append(begins, len(data))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), data]).dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        coded = pa.array(self._pieces(distinct), pa.large_binary()).take(pieces.indices)
        ends = np.frombuffer(coded.buffers()[1], dtype=np.int64)[: len(coded) + 1]
        ids = np.frombuffer(coded.buffers()[2], dtype="<u4", count=int(ends[-1]) // 4)
        return ids, np.diff(ends[np.searchsorted(bounds, offsets)]) // 4


@lru_cache(maxsize=1)
def encoder_of(path: str) -> TextEncoder:
    """The encoder of a file, with what it remembers, for all tasks that a Python worker runs."""
    return TextEncoder(path)


_BLOCK = "part int, block bigint, start bigint, doc_ids array<bigint>, lengths array<bigint>, words binary, escapes binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("escapes", pa.binary())])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in turn, by about ``TEXT_BYTES`` of text."""
    if batch.num_rows:
        sizes = pc.fill_null(pc.binary_length(batch.column("text").cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
        before = np.cumsum(sizes) - sizes
        firsts = [0, *(np.flatnonzero(np.diff(before // TEXT_BYTES)) + 1).tolist(), batch.num_rows]
        for first, last in zip(firsts, firsts[1:]):
            yield batch.slice(first, last - first)


def write(documents: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of every text, each with ``end_id`` after it, to ``folder`` in ascending doc_id order.

    Files hold one range of doc_ids each, in order; a row of a file is a block: its part and place,
    the ids of its part before it, its documents with their numbers of ids, and their ids packed.
    Null ids come first; rows with one id are in the order of a hash of their text; a null text
    is empty. Other columns aren't read; an empty table gives no blocks.
    """

    def run(batches):
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        docs, lengths, ids, held, start, block = [], [], [], 0, 0, 0

        def closed():
            words, escapes = pack(np.concatenate(ids))
            return pa.RecordBatch.from_pylist(
                [{"part": part, "block": block, "start": start, "doc_ids": docs, "lengths": lengths, "words": words, "escapes": escapes}], schema=_SCHEMA
            )

        for batch in batches:
            release_memory()
            for some in _parts(batch):
                coded, counts = encoder.encode_all(some.column("text"))
                coded, counts = np.insert(coded, np.cumsum(counts), end_id), counts + 1
                for doc, one in zip(some.column("doc_id").to_pylist(), np.split(coded, np.cumsum(counts)[:-1])):
                    docs.append(doc)
                    lengths.append(len(one))
                    ids.append(one)
                    held += len(one)
                    if held >= block_ids:
                        yield closed()
                        start, block = start + held, block + 1
                        docs, lengths, ids, held = [], [], [], 0
        if docs:
            yield closed()

    small_batches(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    blocks = texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _BLOCK)
    blocks.write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks of a folder, with the number of ids before each: ``before``."""
    blocks = spark.read.schema(_BLOCK).parquet(folder)
    # One row per part, that is per task of the write: a few bytes each, so this small side is sent to all.
    parts = blocks.groupBy("part").agg(F.max(F.col("start") + F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return blocks.join(F.broadcast(parts.select("part", before.alias("_before"))), "part").withColumn("before", F.col("_before") + F.col("start")).drop("_before")


_DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files: the ids of all documents
    before it, its own, and the CRC-32 of its ids as little-endian unsigned 32-bit numbers."""

    def run(batches):
        for batch in batches:
            release_memory()
            for row in batch.to_pylist():
                ids = unpack(row["words"], row["escapes"]).astype("<u4")
                lengths = np.array(row["lengths"], dtype=np.int64)
                at = np.cumsum(lengths) - lengths
                sums = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), row["lengths"])]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], type=pa.int64()), pa.array(at + row["before"]), pa.array(lengths), pa.array(sums, type=pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read(spark, folder).select("doc_ids", "lengths", "words", "escapes", "before").mapInArrow(run, _DOCS)


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, ids`` of every document in the files."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["words"], row["escapes"]).astype(np.int64)
                ends = np.cumsum([0, *row["lengths"]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], type=pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["doc_id", "ids"])

    return read(spark, folder).mapInArrow(run, "doc_id bigint, ids array<bigint>")
