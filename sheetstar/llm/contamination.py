"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar.llm.common import Scratch, release_memory, small_batches

WINDOW = 13
#: A document is contaminated from one hit word in this many on.
SHARE = 20
#: Benchmark text, in characters, that one automaton holds; a larger benchmark takes several scans.
#: It bounds what is collected and sent to the tasks at once; only a single item may be longer.
BLOCK_CHARS = 8_000_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8").translate(_FOLD).split()


class Windows:
    """The automaton over all windows of some items; its letters are whole words.

    A window is ``width`` words in a row; an item of fewer, but not none, is one window. Every
    window remembers the items it comes from.
    """

    def __init__(self, items, width: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        windows: dict[tuple, set] = {}
        for item, text in items:
            words = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text))
            for i in range(max(1, len(words) - width + 1)) if words else ():
                windows.setdefault(words[i : i + width], set()).add(item)
        self.found = list(windows.items())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for place, (window, _) in enumerate(self.found):
            self.automaton.add_word(window, place)
        if self.found:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """(merged word ranges inside occurrences, items with occurrences) of one text."""
        if not self.found or not words:
            return [], set()
        get = self.ids.get
        ranges, items = [], set()
        for end, place in self.automaton.iter(tuple([get(w, 0) for w in words])):
            window, of = self.found[place]
            items |= of
            ranges.append((end - len(window) + 1, end + 1))
        return merged(ranges), items


def merged(ranges) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def char_spans(text: str, ranges) -> list[tuple[int, int]]:
    """Ranges of words as character offsets of the original text, end exclusive."""
    data = text.encode("utf-8").translate(_FOLD)
    at = [m.span() for m in re.finditer(rb"[^ ]+", data)]
    raw = text.encode("utf-8")
    length = lambda n: len(raw[:n].decode("utf-8"))
    return [(length(at[s][0]), length(at[e - 1][1])) for s, e in ranges]


_SCANNED = "row bigint, doc_id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>, char_starts array<bigint>, char_ends array<bigint>"


def _scan(documents: DataFrame, items: list, width: int) -> DataFrame:
    """One row per document: words, merged hit ranges in words and in characters, items."""

    def run(batches):
        windows = Windows(items, width)
        for batch in batches:
            release_memory()
            columns = [[] for _ in range(8)]
            for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                words = words_of(text)
                ranges, found = windows.scan(words)
                spans = char_spans(text, ranges) if ranges else []
                values = (row, doc, len(words), [s for s, _ in ranges], [e for _, e in ranges], sorted(map(str, found)), [s for s, _ in spans], [e for _, e in spans])
                for column, value in zip(columns, values):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.string())] + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _SCANNED.split(", ")])

    return documents.mapInArrow(run, _SCANNED)


def _blocks(benchmark: DataFrame, block_chars: int) -> tuple[int, Iterator[list]]:
    """The number of blocks of about ``block_chars`` characters, and the items of one block after the other.

    A block is collected when it is asked for. Several are split beforehand, in one exchange.
    """
    spark = benchmark.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("item_id is not null and text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))

    def collected():
        if n == 1:
            yield [(r.item_id, r.text) for r in items.collect()]
            return
        folder = Scratch(spark, "benchmark").path("blocks")
        split = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        split.repartition("block").write.partitionBy("block").parquet(folder)
        kept = spark.read.schema(split.schema).parquet(folder)
        for i in range(n):
            yield [(r.item_id, r.text) for r in kept.filter(F.col("block") == i).select("item_id", "text").collect()]

    return n, collected()


def scan(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, share: int = SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans, contaminated`` for every row of ``documents (doc_id, text)``.

    A document word inside any occurrence of a benchmark window is hit; ``items`` are the ids of
    the items with occurring windows, sorted as strings; ``spans`` the hit stretches as character offsets
    of the original text. Contaminated: some word is hit, and ``share`` times the hit words reach all words.
    Null and empty texts have no words; items with null id or text have no windows; repeated items
    count once, repeated rows keep their rows; other columns aren't read; empty tables are fine.
    """
    # A benchmark that fits one automaton is one pass; further blocks are merged by row.
    n_blocks, blocks = _blocks(benchmark, block_chars)
    rows = documents.select(F.lit(0).cast("bigint").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if n_blocks == 1:
        scanned = _scan(rows, next(blocks), width)
        ranges = F.arrays_zip("starts", "ends")
        return _judged(scanned.select("doc_id", "n_words", "items", ranges.alias("ranges"), F.arrays_zip(F.col("char_starts").alias("start"), F.col("char_ends").alias("end")).alias("spans")), share)
    scratch = Scratch(documents.sparkSession, "windows")
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    # Each block's scan is written before the next block is collected. The first has every row, the others those they hit.
    every = None
    for items in blocks:
        one = _scan(rows, items, width)
        one = scratch.keep(one if every is None else one.filter(F.size("items") > 0), "scanned")
        every = one if every is None else every.unionByName(one)
    gathered = every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias("words"),
        F.flatten(F.collect_list(F.arrays_zip(F.col("char_starts").alias("starts"), F.col("char_ends").alias("ends")))).alias("chars"),
    )
    joined = gathered.select("doc_id", "n_words", "items", _merged("words").alias("ranges"), _merged("chars").alias("_spans"))
    return _judged(joined.select("doc_id", "n_words", "items", "ranges", F.transform("_spans", lambda s: F.struct(s["starts"].alias("start"), s["ends"].alias("end"))).alias("spans")), share)


def _merged(column: str):
    """Overlapping or touching ranges of an array as one."""

    def step(done, r):
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], r["ends"]).alias("ends"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["ends"] >= r["starts"]), grown).otherwise(F.array_append(done, r))

    return F.aggregate(F.array_sort(column), F.expr("cast(array() as array<struct<starts: bigint, ends: bigint>>)"), step)


def _judged(scanned: DataFrame, share: int) -> DataFrame:
    hit = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda n, r: n + r["ends"] - r["starts"])
    return scanned.withColumn("n_hit", hit).select(
        "doc_id", "n_words", "n_hit", "items", "spans", ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")
    )


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the query."""
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def clean(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, share: int = SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``documents`` without the contaminated ones, all columns kept.

    A row's verdict depends on its text alone. With one automaton, texts are judged where they lie and
    never move; with several, each text is scanned once by each and the verdict joined by the text's hash.
    """
    n_blocks, blocks = _blocks(benchmark, block_chars)
    if n_blocks > 1:
        sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
        texts = documents.select(sha.alias("_sha"), "text").dropDuplicates(["_sha"]).withColumn("doc_id", F.monotonically_increasing_id())
        texts = Scratch(documents.sparkSession, "texts").keep(texts, "texts")
        bad = scan(texts, benchmark, width, share, block_chars).filter("contaminated").select("doc_id")
        shas = texts.join(bad, "doc_id").select("_sha")
        return documents.join(shas, sha == shas["_sha"], "left_anti")
    items, at = next(blocks), documents.columns.index("text")

    def run(batches):
        windows = Windows(items, width)
        for batch in batches:
            release_memory()
            keep = []
            for text in batch.column(at):
                words = words_of(text.as_py())
                hit = sum(e - s for s, e in windows.scan(words)[0])
                keep.append(not (hit and share * hit >= len(words)))
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
