"""SentencePiece ids of whole texts by a table of prefixes, and texts from ids.

Merge-type models join neighbouring pieces by score. Every prefix of a text then has one last token
only: of the tokens that end there, the one that fits the last token of the prefix before it. Two
tokens fit if their joined text is encoded as these two. An automaton gives the tokens that end at
each place; ids are recovered from the end of the table backwards.
"""

from __future__ import annotations

import re
import string
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar.llm.common import release_memory, small_batches

#: Fixed values of the format: how models write a space, and what the unknown token is decoded to.
SPACE = "▁"
UNKNOWN = " ⁇ "
#: Bounds of what a worker remembers: segments and their longest, pairs of tokens. Others are worked out anew.
REMEMBERED = 200_000
REMEMBERED_LENGTH = 40
REMEMBERED_PAIRS = 1_000_000
#: Letters that words are cut after, if the model has no piece of such a letter and ASCII punctuation.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ"
#: Nothing is before the first token of a segment.
START = -1


def public_model() -> str:
    """The public merge-type model that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The tokens of a model and how each is merged from smaller ones."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.text = [model.id_to_piece(i) for i in every]
        self.bytes = {int(self.text[i][3:5], 16): i for i in every if model.is_byte(i)}
        self.control = {i for i in every if model.is_control(i)}
        self.unknown = model.unk_id()
        special = set(self.bytes.values()) | self.control | {self.unknown}
        if any(model.is_unused(i) for i in every):
            raise ValueError("models with unused pieces aren't supported")
        score = {i: model.get_score(i) for i in every if i not in special}
        place = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.ids = {self.text[i]: i for i in score}
        #: When a piece comes to be, in the order of scores; single characters are there from the start.
        self.rank = {i: place[s] if len(self.text[i]) > 1 else -1 for i, s in score.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        shared, seen = set(), set()
        for rank in self.rank.values():
            (shared if rank in seen else seen).add(rank)
        self.irregular: set[int] = set()
        self.whole: list[int] = []
        for text, i in self.ids.items():
            found, last = self.merged(text)
            if found != [i]:
                continue  # no merges lead to it, so no text has it
            self.whole.append(i)
            if last:
                self.parts[i] = last
                # Two pieces of one score merge from left to right; a piece made before its parts' turn merges at once.
                if self.rank[i] in shared or any(p in self.irregular or self.rank[p] >= self.rank[i] for p in last):
                    self.irregular.add(i)

    def merged(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Ids of a short text of known characters by its merges, one after the other, and the last merge."""
        symbols, last = list(text), None
        while len(symbols) > 1:
            best = None
            for at in range(len(symbols) - 1):
                i = self.ids.get(symbols[at] + symbols[at + 1])
                if i is not None and (best is None or self._order(i) < best[0]):
                    best = self._order(i), at
            if best is None:
                break
            at = best[1]
            last = self.ids[symbols[at]], self.ids[symbols[at + 1]]
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return [self.ids.get(s, self.unknown) for s in symbols], last

    def _order(self, i: int) -> int:
        return self.rank[i]

    def fit(self, a: int, b: int) -> bool:
        """Whether the texts of ``a`` and ``b`` side by side are encoded as these two tokens.

        Goes back in time from the finished tokens: whichever of the two at the border was made later
        is taken apart. They don't fit if a piece across the border would have been made while both were there.
        """
        if a in self.irregular or b in self.irregular:
            return self.merged(self.text[a] + self.text[b])[0] == [a, b]
        rank, end_a, end_b = self.rank, None, None
        while True:
            across = self.ids.get(self.text[a] + self.text[b])
            if across is not None:
                at = rank[across]
                # Of equal merges the left one is first: before one across the border, or after it.
                if (end_a is None or at < end_a) and (end_b is None or at <= end_b):
                    return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                end_a, a = rank[a], self.parts[a][1]
            else:
                end_b, b = rank[b], self.parts[b][0]


class PrefixEncoder:
    """Ids of texts, segment by segment; most segments of a text were met before."""

    def __init__(self, path: str):
        self.pieces = pieces = Pieces(path)
        self.automaton = ahocorasick.Automaton()
        for i in pieces.whole:
            self.automaton.add_word(pieces.text[i], (len(pieces.text[i]), i))
        self.automaton.make_automaton()
        self.characters = {t for t in pieces.ids if len(t) == 1}
        self.segments = self._cuts(pieces.ids)
        self.known: dict[str, bytes] = {}
        self.fitting: dict[tuple[int, int], bool] = {}

    def _cuts(self, texts) -> re.Pattern | None:
        """Segments between places that no token spans: before a space, and where the model has no piece
        across it, around a line feed and between punctuation and other characters."""
        if any(SPACE in t.lstrip(SPACE) for t in texts):
            return None
        letter, mark = re.compile(f"[{LETTERS}]"), f"[{re.escape(string.punctuation)}]"
        touching = re.compile(f"[{LETTERS}]{mark}|{mark}[{LETTERS}]")
        if any("\n" in t or touching.search(t) for t in texts):
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(
            rf"{SPACE}*{letter.pattern}+(?={mark}|[{SPACE}\n]|\Z)|{SPACE}*{mark}+(?={letter.pattern}|[{SPACE}\n]|\Z)|{SPACE}+(?=\n|\Z)|\n"
            rf"|{SPACE}*[^{SPACE}\n]+?(?:(?<={letter.pattern})(?={mark})|(?<={mark})(?={letter.pattern})|(?=[{SPACE}\n]|\Z))"
        )

    def last_tokens(self, text: str) -> list[int]:
        """The one last token of every prefix of a text of known characters; ``START`` for the empty one."""
        last = [START] + [None] * len(text)
        fitting, fit = self.fitting, self.pieces.fit
        for end, (length, token) in self.automaton.iter(text):
            if last[end + 1] is None:
                before = last[end + 1 - length]
                if before == START:
                    last[end + 1] = token
                    continue
                fits = fitting.get((before, token))
                if fits is None:
                    if len(fitting) >= REMEMBERED_PAIRS:
                        fitting.clear()
                    fits = fitting[before, token] = fit(before, token)
                if fits:
                    last[end + 1] = token
        return last

    def _known_ids(self, text: str) -> list[int]:
        last, ids, at = self.last_tokens(text), [], len(text)
        while at:
            token = last[at]
            ids.append(token)
            at -= len(self.pieces.text[token])
        return ids[::-1]

    def _segment(self, text: str) -> bytes:
        if self.characters.issuperset(text):
            return array("i", self._known_ids(text)).tobytes()
        # A character that is no piece is in no token: it becomes its bytes, or the unknown token, one for a run of them.
        ids, at = [], 0
        while at < len(text):
            end = at
            known = text[at] in self.characters
            while end < len(text) and (text[end] in self.characters) == known:
                end += 1
            if known:
                ids += self._known_ids(text[at:end])
            elif self.pieces.bytes:
                ids += [self.pieces.bytes[b] for b in text[at:end].encode()]
            else:
                ids.append(self.pieces.unknown)
            at = end
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as native 32-bit integers."""
        text = self.pieces.model.normalize(text)
        if self.segments is None:
            return self._segment(text)
        segments = self.segments.findall(text)
        known = self.known
        coded = list(map(known.get, segments))
        if None in coded:
            for i, ids in enumerate(coded):
                if ids is None:
                    segment = segments[i]
                    ids = known.get(segment)
                    if ids is None:
                        ids = self._segment(segment)
                        if len(known) < REMEMBERED and len(segment) <= REMEMBERED_LENGTH:
                            known[segment] = ids
                    coded[i] = ids
        return b"".join(coded)


class PieceDecoder:
    """Texts of ids: pieces with spaces for their mark, bytes as the characters they make up."""

    def __init__(self, path: str):
        pieces = Pieces(path)
        self.byte = {i: b for b, i in pieces.bytes.items()}
        self.control = pieces.control
        self.part = [t.replace(SPACE, " ").encode() for t in pieces.text]
        for i, b in self.byte.items():
            self.part[i] = bytes([b])
        for i in self.control:
            self.part[i] = b""
        self.part[pieces.unknown] = UNKNOWN.encode()
        self.marked = {i for t, i in pieces.ids.items() if t.startswith(SPACE)}
        self.prefix = pieces.model.normalize("a").startswith(SPACE)

    def decode(self, ids: list[int]) -> str:
        parts = list(map(self.part.__getitem__, ids))
        if self.prefix:
            first = next((at for at, i in enumerate(ids) if i not in self.control), None)
            if first is not None and ids[first] in self.marked:
                parts[first] = parts[first][1:]
        if self.control.isdisjoint(ids):
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return self._repaired(ids, parts)

    def _repaired(self, ids: list[int], parts: list[bytes]) -> str:
        """Bytes that make up no character are each replaced by the replacement character."""
        out, run = [], b""
        for i, part in zip([*ids, None], [*parts, b""]):
            if i in self.byte:
                run += part
                continue
            while run:
                for length in (4, 3, 2, 1):
                    try:
                        found = run[:length].decode()
                    except UnicodeDecodeError:
                        continue
                    if len(found) == 1:
                        break
                else:
                    found, length = "�", 1
                out.append(found)
                run = run[length:]
            out.append(part.decode())
        return "".join(out)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> PrefixEncoder:
    """The encoder of a model, with what it remembers, for all tasks that a Python worker runs."""
    return PrefixEncoder(path)


@lru_cache(maxsize=1)
def decoder_of(path: str) -> PieceDecoder:
    return PieceDecoder(path)


def encode(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids`` of every whole text of ``documents (doc_id, text)`` by the file of a merge-type model.

    Equal to the library's ids without begin and end ids and without sampling; a null or empty text has
    none. Rows stay where they are, repeated and null ids each keep theirs; other columns aren't read;
    an empty table gives no rows. ``model`` is a path that every executor has.
    """
    small_batches(documents.sparkSession)

    def run(batches):
        encoder = encoder_of(model)
        for batch in batches:
            release_memory()
            coded = [encoder.encode(text.as_py() or "") for text in batch.column("text")]
            ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), ids)], ["doc_id", "ids"])

    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def _lists(column: pa.ListArray):
    """The lists of a column as Python's, null ones as empty; numbers are turned into Python's a whole list at once."""
    ends, values = column.offsets.to_pylist(), column.values.to_numpy(zero_copy_only=False)
    there = column.is_valid().to_pylist()
    for i, j, ok in zip(ends, ends[1:], there):
        yield values[i:j].tolist() if ok else []


def decode(encoded: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the ``text`` of the ids of every row of ``encoded (ids)``; null ids give an empty text."""
    small_batches(encoded.sparkSession)

    def run(batches):
        decoder = decoder_of(model)
        for batch in batches:
            release_memory()
            texts = [decoder.decode(ids) for ids in _lists(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, "text"])

    rows = encoded.select(*keep, "ids")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}text string")


def digests(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the ids of every text and of what they are decoded to."""
    coded = encode(documents, model).select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"))
    coded = coded.withColumn("ids_sha256", F.sha2(F.array_join("ids", ","), 256))
    back = decode(coded, model, ("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
