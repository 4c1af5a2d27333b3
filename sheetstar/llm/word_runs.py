"""Periodic runs of words in whole texts by internal pattern matching.

Blocks of 1, 2, 4, … words at multiples of their length ask where they occur again in the windows next to
them. A block's occurrences are a range of the suffix array; a wavelet tree over that array gives
the first of them after a place. In a window no longer than the block, occurrences form a progression:
of three or more terms, only the two shifts that map the ends of the block's own run onto those of the
progression's can be periods of longer runs; of fewer, each shift can. Candidates are then extended to
both sides and kept if they are long enough and no smaller period gives the same run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetstar.llm.common import SPACES, release_memory, small_batches

#: A run has at least so many words, and at least so many times its period.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words of several texts worked on at once; a longer text is worked on alone.
CHUNK_WORDS = 150_000


class Names:
    """Names of the blocks of 1, 2, 4, … words at every place of texts that lie one after the other.

    A name is where the block's range in the suffix array begins; blocks of different texts differ.
    Arrays are doubled until every suffix has its own name, so the last names are the suffix array's inverse.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray):
        n = len(words)
        sizes = np.diff(np.append(starts, n))
        self.text = np.repeat(np.arange(len(starts)), sizes)
        self.end = np.repeat(starts + sizes, sizes)
        self.sizes = sizes
        order = np.lexsort((words, self.text))
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (words[order][1:] != words[order][:-1]) | (self.text[order][1:] != self.text[order][:-1])
        self.levels: list[np.ndarray] = []
        self._name(order, fresh)
        length, place = 1, np.arange(n)
        while True:
            names = self.levels[-1]
            first = names[order]
            again = np.flatnonzero((np.diff(first, append=-1) == 0) | (np.diff(first, prepend=-1) == 0))
            if not len(again):
                break
            # Only suffixes that share their name with others are ordered further, inside their ranges.
            at = order[again]
            next_ = at + length
            second = np.where(next_ < self.end[at], names[np.minimum(next_, n - 1)].astype(np.int64), -1)
            turn = np.lexsort((second, first[again]))
            order = order.copy()
            order[again] = at[turn]
            fresh = np.ones(n, dtype=bool)
            same = (np.diff(first[again][turn], prepend=-1) == 0) & (np.diff(second[turn], prepend=-2) == 0)
            fresh[again] = ~same
            length *= 2
            self._name(order, fresh)
        self.suffixes = order

    def _name(self, order: np.ndarray, fresh: np.ndarray) -> None:
        begin = np.flatnonzero(fresh)
        names = np.empty(len(order), dtype=np.int32)
        names[order] = np.repeat(begin, np.diff(np.append(begin, len(order))))
        self.levels.append(names)

    def ranges(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of the suffix array that holds the blocks equal to those at ``at``."""
        names = self.levels[min(level, len(self.levels) - 1)]
        sizes = np.bincount(names, minlength=1)
        return names[at].astype(np.int64), names[at] + sizes[names[at]]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For how many words the same words follow from ``a`` and ``b``, places of one text, a < b."""
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        last = len(self.text) - 1
        for level in range(len(self.levels) - 1, -1, -1):
            names, length = self.levels[level], 1 << level
            inside = b + length <= self.end[np.minimum(b, last)] if len(b) else np.zeros(0, dtype=bool)
            inside &= b <= last
            inside[inside] = self.text[b[inside]] == self.text[a[inside]]
            same = inside & (names[np.minimum(a, last)] == names[np.minimum(b, last)])
            step = np.where(same, length, 0)
            a, b, n = a + step, b + step, n + step
        return n

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For how many words the same words stand before ``a`` and ``b``."""
        start = (self.end - self.sizes[self.text])[a] if len(a) else a
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            names, length = self.levels[level], 1 << level
            same = a - length >= start
            same &= names[np.maximum(a - length, 0)] == names[np.maximum(b - length, 0)]
            step = np.where(same, length, 0)
            a, b, n = a - step, b - step, n + step
        return n


class WaveletTree:
    """Counts and successors among the numbers in any range of an array, one bit of them at a time."""

    def __init__(self, numbers: np.ndarray, bits: int):
        self.bits = bits
        self.zeros: list[np.ndarray] = []
        for bit in range(bits - 1, -1, -1):
            one = (numbers >> bit) & 1 == 1
            self.zeros.append(np.concatenate(([0], np.cumsum(~one))).astype(np.int32))
            numbers = np.concatenate((numbers[~one], numbers[one]))

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of ``[low, high)`` are smaller than ``x``."""
        low, high, count = low.astype(np.int64), high.astype(np.int64), np.zeros(len(low), dtype=np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            to_low, to_high, all_ = zeros[low], zeros[high], int(zeros[-1])
            one = (x >> bit) & 1 == 1
            count += np.where(one, to_high - to_low, 0)
            low, high = np.where(one, all_ + low - to_low, to_low), np.where(one, all_ + high - to_high, to_high)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number with ``k`` smaller ones in ``[low, high)``, which has more than ``k``."""
        low, high, k = low.astype(np.int64), high.astype(np.int64), k.copy()
        found = np.zeros(len(low), dtype=np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            to_low, to_high, all_ = zeros[low], zeros[high], int(zeros[-1])
            one = k >= to_high - to_low
            k = np.where(one, k - (to_high - to_low), k)
            found |= one.astype(np.int64) << bit
            low, high = np.where(one, all_ + low - to_low, to_low), np.where(one, all_ + high - to_high, to_high)
        return found


def _windows(names: Names) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(level, length, places of blocks, first starts of their windows), windows as long as the blocks.

    A run of period q >= 8 holds a whole block of the largest power of two up to q / 2 words that begins in its
    first half period; the block occurs again one period on, that is two to four lengths on. A run of a smaller
    period has 24 words at least and holds a block of 8 words, with the next occurrence 1 to 8 places on.
    """
    start = names.end - names.sizes[names.text]
    inner = np.arange(len(names.text)) - start
    out, level = [], 2
    longest = int(names.sizes.max(initial=0))
    blocks = np.flatnonzero(inner % 8 == 0)
    out.append((3, 8, blocks, blocks + 1))
    while 2 << level <= longest // LEAST_PERIODS:
        length = 1 << level
        blocks = np.flatnonzero(inner % length == 0)
        out += [(level, length, blocks, blocks + 2 * length), (level, length, blocks, blocks + 3 * length)]
        level += 1
    return out


def runs_of(words: np.ndarray, starts: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows ``(text, start, length, period)`` of all runs in texts of word numbers, which begin at ``starts``.

    ``least`` must be 24 or more and ``periods`` 3 or more: shorter runs needn't hold a block that tells them.
    """
    if least < LEAST_WORDS or periods < LEAST_PERIODS:
        raise ValueError(f"runs of fewer than {LEAST_WORDS} words or {LEAST_PERIODS} periods can't be told by blocks")
    if not len(words):
        return np.empty((0, 4), dtype=np.int64)
    names = Names(words, starts)
    first = names.end - names.sizes[names.text]
    tree = WaveletTree(names.suffixes - first[names.suffixes], int(names.sizes.max()).bit_length())
    at_all, shift_all = [], []

    def candidates(at, shift):
        at_all.append(at)
        shift_all.append(shift)

    for level, length, at, window in _windows(names):
        inside = window + length <= names.end[at]
        at, window = at[inside], window[inside]
        low, high = names.ranges(level, at)
        several = high - low > 1
        at, window, low, high = at[several], window[several], low[several], high[several]
        if not len(at):
            continue
        offset = first[at]
        stop = np.minimum(window + length, names.end[at])
        before = tree.below(low, high, window - offset)
        count = tree.below(low, high, stop - offset) - before
        met = count > 0
        at, low, high, before, count, offset = at[met], low[met], high[met], before[met], count[met], offset[met]
        if not len(at):
            continue
        one = tree.nth(low, high, before) + offset
        candidates(at, one - at)
        more = count > 1
        two = tree.nth(low[more], high[more], before[more] + 1) + offset[more]
        pair = count[more] == 2
        candidates(at[more][pair], two[pair] - at[more][pair])
        # A progression: the block's own run of the common difference, and the run of the occurrences.
        at, one, step = at[more][~pair], one[more][~pair], (two - one[more])[~pair]
        if len(at):
            candidates(at, step)
            for own, other in ((at - names.behind(at, at + step), one - names.behind(one, one + step)), (at + names.ahead(at, at + step), one + names.ahead(one, one + step))):
                candidates(at, other - own)
    at, shift = np.concatenate(at_all or [np.empty(0, np.int64)]), np.concatenate(shift_all or [np.empty(0, np.int64)])
    fits = (shift > 0) & (at + shift < names.end[at]) if len(at) else np.empty(0, dtype=bool)
    at, shift = at[fits], shift[fits]
    begin = at - names.behind(at, at + shift)
    size = at + names.ahead(at, at + shift) + shift - begin
    long = (size >= least) & (size >= periods * shift)
    found = np.stack([names.text[at[long]], begin[long] - first[at[long]], size[long], shift[long]], axis=1).reshape(-1, 4)
    # Multiples of a period give the same run: the smallest comes first and stays.
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    keep = np.ones(len(found), dtype=bool)
    keep[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[keep]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a run ``(start, length, period)`` holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find(documents: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``documents (doc_id, text)``.

    Words are what stands between spaces, tabs, line feeds and the like. ``runs`` are all stretches of at
    least ``least`` words and ``periods`` smallest periods that no neighbouring word extends, by start,
    then period; ``collapsed`` is the text without what repeats: words that a run holds after its first period
    are left out, the others joined by one space. A null or empty text has no words. Rows stay where they are,
    repeated and null ids each keep theirs; other columns aren't read; an empty table gives no rows. A text is
    worked on whole, in memory of some 300 bytes a word; several short ones are worked on together.
    """
    small_batches(documents.sparkSession)

    def solve(texts: list[list[bytes]]) -> list[tuple]:
        codes: dict[bytes, int] = {}
        numbers = np.array([codes.setdefault(w, len(codes)) for words in texts for w in words], dtype=np.int64)
        full = [i for i, words in enumerate(texts) if words]
        starts = np.cumsum([0, *(len(texts[i]) for i in full)])[:-1].astype(np.int64)
        found = runs_of(numbers, starts, least, periods)
        bounds = np.searchsorted(found[:, 0], np.arange(len(full) + 1))
        out = [(0, [], "")] * len(texts)
        for k, i in enumerate(full):
            runs, words = found[bounds[k] : bounds[k + 1], 1:], texts[i]
            if len(runs):
                gone = dropped(len(words), runs)
                out[i] = (len(words), [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()], b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
            else:
                out[i] = (len(words), [], b" ".join(words).decode())
        return out

    def run(batches):
        for batch in batches:
            release_memory()
            solved, texts, held = [], [], 0
            for text in batch.column("text"):
                # These are the six separators that bytes are split at.
                texts.append((text.as_py() or "").encode().split())
                held += len(texts[-1])
                if held >= CHUNK_WORDS:
                    solved += solve(texts)
                    texts, held = [], 0
            solved += solve(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s[0] for s in solved], pa.int64()), pa.array([s[1] for s in solved], pa.list_(_RUN)), pa.array([s[2] for s in solved], pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    texts = documents.select("doc_id", "text")
    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def planted(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` with the repetitions that the query's contract puts into a tenth of the texts, by id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"[^{SPACES}]+"), F.lit(0))
    n = F.size("_words")
    g = F.floor(h / 10).cast("bigint")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
    kept = documents.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"))
    again = kept.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, p))
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    places = F.transform(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1), place)
    text = F.array_join(F.transform(places, lambda i: F.get("_words", i.cast("int"))), " ")
    return again.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def _better(a: Column, b: Column) -> Column:
    """Whether run ``b`` has the greater exact exponent, or the same and is first by start, then period."""
    mine, other = a["length"] * b["period"], b["length"] * a["period"]
    first = (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))
    return (other > mine) | ((other == mine) & first)


def digest(found: DataFrame) -> DataFrame:
    """The numbers of the most repetitive run of each text, and hashes of all runs and of the collapsed text."""
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(_better(a, b), b).otherwise(a))
    told = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("_best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return told.select(
        "doc_id", "n_runs", "_best.start", "_best.length", "_best.period",
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
