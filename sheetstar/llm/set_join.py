"""Jaccard self-join of word n-gram sets by index lists in blocks and answers derived from similar sets.

1. Shingles found in one set only can't be shared. They are told apart by one exchange of all
   shingles in packed, sorted blocks; with the rarest first in a set's order, most sets turn out to
   have no shared shingle in the prefix that a partner must share, and leave.
2. The others enter an index: shingle -> sets, in blocks of similar size. First every set is compared
   with one leader per list only; linked sets keep what they lack of their leader.
3. Sets with one leader then act as one entry of a list, so a list's many copies are skipped together.
   Two leaders' overlap bounds that of all their members from above; only where the bound leaves
   a link open are members compared.

Everything is exact up to equal 64-bit hashes of different shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar.llm.common import SPACES, Scratch, components, release_memory, small_batches
from sheetstar.llm.words import WordHasher, chunks, mixed, shingles, text_buffers

WIDTH = 5
#: Sets link when OF * |both| >= AT_LEAST * |either|.
AT_LEAST, OF = 75, 100
#: Shingles that one task of the exchange holds at once, and that a map task gathers before it packs them.
GROUP_SHINGLES = 1_000_000
PACK_SHINGLES = 500_000
#: Rounds in which sets outside the largest component of a list ask one of its members.
TURNS = 4


def _pack(sorted_values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed gaps, byte by place."""
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(packed, decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(8, n).T).view(np.uint64).ravel())


def _sets(batch: pa.RecordBatch, hasher: WordHasher, width: int):
    """(row, sorted distinct shingles) of every text with a word."""
    offsets, data = text_buffers(batch.column("text"))
    for i, j in chunks(offsets):
        words, at = hasher.words(data, offsets[i:j], offsets[i + 1 : j + 1])
        for k in range(j - i):
            if at[k + 1] > at[k]:
                yield i + k, np.unique(shingles(words[at[k] : at[k + 1]], width))


def _key(tokens: np.ndarray) -> np.uint64:
    """Name of a set: a hash of its shingles and their number."""
    with np.errstate(over="ignore"):
        return mixed(np.array([mixed(tokens).sum() + np.uint64(len(tokens))], dtype=np.uint64))[0]


_OWN = "doc_id bigint, text_hash bigint, key bigint, n_shingles bigint"


def own_sets(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, text_hash, key, n_shingles`` per row; equal keys mean equal sets; no words: null key and 0."""

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            release_memory()
            keys, sizes = np.zeros(batch.num_rows, dtype=np.uint64), np.zeros(batch.num_rows, dtype=np.int64)
            for row, tokens in _sets(batch, hasher, width):
                keys[row], sizes[row] = _key(tokens), len(tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys.view(np.int64), mask=sizes == 0), pa.array(sizes)],
                ["doc_id", "text_hash", "key", "n_shingles"],
            )

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, _OWN)


_PACKED = (
    "part bigint, pack bigint, count bigint, tokens binary, counts binary, docs binary, repeats binary, repeat_keys binary, "
    "keys binary, sizes binary, n_held bigint, held_tokens binary, held_counts binary, held_docs binary"
)
#: Stands for the several sets of a pack that hold a shingle.
_SEVERAL = np.uint16(65_535)


def _packed(documents: DataFrame, width: int, parts: int, repeated: np.ndarray) -> DataFrame:
    """All sets' shingles by range of the hash, each shingle once per pack, however many sets share it.

    A set is named by its pack and place. A shingle of one set of the pack carries that place; of several, their
    number: which ones stays with the pack, whose keys, sizes and shared shingles travel with the first of its
    ranges. Only sets that may have copies in other packs carry their key in every range.
    """
    sent = documents.sparkSession.sparkContext.broadcast(repeated)

    def flush(pack, keys, sizes, sets):
        tokens = np.concatenate(sets)
        docs = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, docs = tokens[order], docs[order]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        counts = np.diff(np.append(first, len(tokens))).astype(np.uint16)
        shared = counts > 1
        held = _pack(tokens[first[shared]]), counts[shared].tobytes(), docs[np.repeat(shared, counts)].tobytes()
        tokens, docs = tokens[first], np.where(shared, _SEVERAL, docs[first])
        part = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        keys = np.array(keys, dtype=np.uint64)
        marked = np.append(sent.value[keys % np.uint64(len(sent.value))], np.zeros(65_536 - len(keys), dtype=bool))
        head, rows = (keys.tobytes(), np.array(sizes, dtype=np.uint32).tobytes(), int(shared.sum()), *held), []
        for i, j in zip(cuts, [*cuts[1:], len(tokens)]):
            repeats = np.unique(docs[i:j][marked[docs[i:j]]])
            own = int(part[i]), pack, int(j - i), _pack(tokens[i:j]), counts[i:j].tobytes(), docs[i:j].tobytes(), repeats.tobytes(), keys[repeats].tobytes()
            rows.append((*own, *(head if i == 0 else (b"", b"", 0, b"", b"", b""))))
        names = [c.split()[0] for c in _PACKED.split(", ")]
        for i in range(0, len(rows), 16):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 16])], names)

    def run(batches):
        hasher = WordHasher()
        # Unique over tasks, and the same when a task runs again.
        pack = TaskContext.get().partitionId() << 20
        keys, sizes, sets, held, seen = [], [], [], 0, set()
        for batch in batches:
            release_memory()
            for _, tokens in _sets(batch, hasher, width):
                key = _key(tokens)
                if key in seen:
                    continue
                seen.add(key)
                keys.append(key)
                sizes.append(len(tokens))
                sets.append(tokens)
                held += len(tokens)
                if held >= PACK_SHINGLES or len(sets) == 65_000:
                    yield from flush(pack, keys, sizes, sets)
                    pack, keys, sizes, sets, held, seen = pack + 1, [], [], [], 0, set()
        if sets:
            yield from flush(pack, keys, sizes, sets)

    return documents.select("text").mapInArrow(run, _PACKED)


#: Slots of the table that tells which keys may be repeated. A full table only sends more keys along.
REPEAT_SLOTS = 1 << 22


def _repeated(classes: DataFrame) -> np.ndarray:
    """Whether a slot holds the key of a set that several rows have; at most REPEAT_SLOTS / 32 numbers are collected."""
    # The slot is the unsigned key modulo a power of two, that is its last bits.
    slot = F.col("key").bitwiseAND(F.lit(REPEAT_SLOTS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 32).cast("int"))
    words = classes.filter("copies > 1").groupBy(F.floor(slot / 32).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    table = np.zeros(REPEAT_SLOTS // 32, dtype=np.uint32)
    for r in words:
        table[r["word"]] = r["bits"]
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


_HEAD = "keys binary, sizes binary, n_held bigint, held_tokens binary, held_counts binary, held_docs binary"
_SHARED = f"pack bigint, docs binary, tokens binary, frequencies binary, {_HEAD}"
_OWN_NAME = np.uint64(1 << 63)


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(c.split()[0], pa.int64() if c.endswith("bigint") else pa.binary()) for c in schema.split(", ")])


def _shared(packed: DataFrame) -> DataFrame:
    """Of each range of shingles, those in two sets or more, with their number of sets, by pack."""

    def run(table: pa.Table) -> pa.Table:
        release_memory()
        columns, rows = {n: [] for n in ("tokens", "counts", "packs", "docs", "names")}, []
        head = [c.split()[0] for c in _HEAD.split(", ")]
        for row in table.to_pylist():
            docs = np.frombuffer(row["docs"], dtype=np.uint16)
            name = (np.uint64(row["pack"]) << np.uint64(16)) | docs.astype(np.uint64) | _OWN_NAME
            repeats = np.frombuffer(row["repeats"], dtype=np.uint16)
            if len(repeats):
                at = np.minimum(np.searchsorted(repeats, docs), len(repeats) - 1)
                name = np.where(repeats[at] == docs, np.frombuffer(row["repeat_keys"], dtype=np.uint64)[at] & ~_OWN_NAME, name)
            counts = np.frombuffer(row["counts"], dtype=np.uint16)
            packs = np.full(len(docs), row["pack"], dtype=np.int64)
            for column, value in zip(columns.values(), (_unpack(row["tokens"], row["count"]), counts, packs, docs, name)):
                column.append(value)
            if row["keys"]:
                rows.append((row["pack"], b"", b"", b"", *(row[n] for n in head)))
        tokens, counts, packs, docs, names = map(np.concatenate, columns.values())
        order = np.argsort(tokens)
        twin = np.zeros(len(tokens) + 1, dtype=bool)
        twin[1:-1] = tokens[order][1:] == tokens[order][:-1]
        stay = order[twin[1:] | twin[:-1] | (counts[order] > 1)]
        tokens, counts, packs, docs, names = (x[stay] for x in (tokens, counts, packs, docs, names))
        # A set that several packs hold counts once.
        order = np.lexsort((names, tokens))
        tokens, counts, packs, docs, names = (x[order] for x in (tokens, counts, packs, docs, names))
        if len(tokens):
            new = np.append(True, tokens[1:] != tokens[:-1])
            other = new | np.append(True, names[1:] != names[:-1])
            group = np.cumsum(new) - 1
            frequency = np.bincount(group, weights=np.where(counts > 1, counts, other))[group].astype(np.uint32)
            kept = frequency > 1
            order = np.flatnonzero(kept)[np.argsort(packs[kept], kind="stable")]
            tokens, packs, docs, frequency = tokens[order], packs[order], docs[order], frequency[order]
            cuts = np.flatnonzero(np.append(True, packs[1:] != packs[:-1])) if len(packs) else []
            for i, j in zip(cuts, [*cuts[1:], len(tokens)]):
                rows.append((int(packs[i]), docs[i:j].tobytes(), tokens[i:j].tobytes(), frequency[i:j].tobytes(), b"", b"", 0, b"", b"", b""))
        kinds = _arrow(_SHARED)
        return pa.table([list(c) for c in zip(*rows)] if rows else [[]] * len(kinds), schema=kinds)

    return packed.groupBy("part").applyInArrow(run, _SHARED)


_KEPT = "key bigint, n bigint, alone bigint, tokens array<bigint>"


def _kept(shared: DataFrame, at_least: int, of: int) -> DataFrame:
    """Sets with a shared shingle in their prefix; ``tokens`` are the shared ones, rarest first.

    ``alone`` counts the set's other shingles, which come before these in the order. A set that
    several packs hold comes from each of them alike.
    """

    def run(table: pa.Table) -> pa.Table:
        release_memory()
        docs, tokens, frequency, head = [], [], [], None
        for row in table.to_pylist():
            if row["keys"]:
                head = row
                continue
            docs.append(np.frombuffer(row["docs"], dtype=np.uint16))
            tokens.append(np.frombuffer(row["tokens"], dtype=np.uint64))
            frequency.append(np.frombuffer(row["frequencies"], dtype=np.uint32))
        if not docs:
            empty = pa.array([], pa.int64())
            return pa.table({"key": empty, "n": empty, "alone": empty, "tokens": pa.array([], pa.list_(pa.int64()))})
        keys, sizes = np.frombuffer(head["keys"], dtype=np.uint64), np.frombuffer(head["sizes"], dtype=np.uint32).astype(np.int64)
        docs, tokens, frequency = map(np.concatenate, (docs, tokens, frequency))
        # Shingles of several sets of the pack: each comes back once, with its number of sets, and goes to all of them.
        several = docs == _SEVERAL
        if several.any():
            held, counts = _unpack(head["held_tokens"], head["n_held"]), np.frombuffer(head["held_counts"], dtype=np.uint16)
            order = np.argsort(tokens[several])
            docs = np.concatenate([docs[~several], np.frombuffer(head["held_docs"], dtype=np.uint16)])
            frequency = np.concatenate([frequency[~several], np.repeat(frequency[several][order], counts)])
            tokens = np.concatenate([tokens[~several], np.repeat(held, counts)])
        order = np.lexsort((tokens, frequency, docs))
        docs, tokens = docs[order], tokens[order]
        first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
        last = np.append(first[1:], len(docs))
        n = sizes[docs[first]]
        alone = n - (last - first)
        prefix = n - (at_least * n + of - 1) // of + 1
        stay = np.flatnonzero(alone < prefix)
        lengths = (last - first)[stay]
        flat = np.concatenate([tokens[first[s] : last[s]] for s in stay]) if len(stay) else np.empty(0, dtype=np.uint64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(flat.view(np.int64)))
        return pa.table({"key": keys[docs[first[stay]]].view(np.int64), "n": n[stay], "alone": alone[stay], "tokens": lists})

    return shared.groupBy("pack").applyInArrow(run, _KEPT)


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` with the sizes of both sets and their overlap; ``rest_b``: what b shares with others, but not with a."""
    a = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = F.size(F.array_intersect("t_a", "t_b")).cast("bigint").alias("both")
    counted = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", both, F.size("t_b").cast("bigint").alias("shared_b"))
    return counted.withColumn("rest_b", F.col("shared_b") - F.col("both")).drop("shared_b")


def _may_link(at_least: int, of: int):
    """Whether an entry (``n, pos``) and another (``m.n, m.pos``) of a list may be of linked sets, were this
    the first shingle they share: by their sizes, and by what is left of both from there on."""
    n, m = F.col("n"), F.col("m.n")
    left = F.least(n - F.col("pos"), m - F.col("m.pos"))
    return (of * n >= at_least * m) & (of * m >= at_least * n) & ((at_least + of) * left >= at_least * (n + m))


def _undecided(index: DataFrame, named: DataFrame) -> DataFrame:
    """``token, id, n, pos, component`` of the lists that sets of more than one component share."""
    entries = index.select("token", "id", "n", "pos").join(named.withColumnRenamed("node", "id"), "id", "left")
    entries = entries.withColumn("component", F.coalesce("component", "id"))
    mixed_lists = entries.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return entries.join(mixed_lists.select("token"), "token", "left_semi")


def _towards_largest(entries: DataFrame, turn: int, at_least: int, of: int) -> DataFrame:
    """``a, b``: every set outside the largest component of one of its lists, with a member of that component.

    The member differs by list and turn, so a set that belongs to a large group of copies soon meets
    one that it links with; what is asked stays within the length of the lists. Pairs whose sizes
    or places in the list speak against a link aren't asked here.
    """
    parts = entries.groupBy("token", "component").agg(F.count("*").alias("size"), F.min_by(F.struct("id", "n", "pos"), F.xxhash64("id", "token", F.lit(turn))).alias("m"))
    largest = parts.groupBy("token").agg(F.max_by(F.struct("component", "m"), F.struct("size", "component")).alias("top"))
    met = entries.join(largest.select("token", "top.component", "top.m").withColumnRenamed("component", "largest"), "token").filter(
        (F.col("component") != F.col("largest")) & _may_link(at_least, of)
    )
    return met.select(F.col("m.id").alias("a"), F.col("id").alias("b")).distinct()


def linked(documents: DataFrame, width: int = WIDTH, at_least: int = AT_LEAST, of: int = OF, group_shingles: int = GROUP_SHINGLES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): ``doc_id, text_hash, key, n_shingles`` per row of ``documents``; ``key, id, first``
    of every distinct set, with a number of its own and the ``(no_id, doc_id, text_hash)`` of its row with the smallest doc_id,
    null only where all its rows have none; and ``a, b`` between numbers of different sets that connect all sets that any
    links connect. Not all links within a component are among them."""
    small_batches(documents.sparkSession)
    scratch = Scratch(documents.sparkSession, "sets")
    rows = scratch.keep(own_sets(documents, width), "rows")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = rows.filter("key is not null").groupBy("key").agg(F.min(first).alias("first"), F.max("n_shingles").alias("n"), F.count("*").alias("copies"))
    # Numbers in the order of doc_ids: a list's leader is then its oldest set. Two sets under one doc_id have a number each.
    classes = scratch.keep(classes.orderBy("first", "key").withColumn("id", F.monotonically_increasing_id()), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // group_shingles))
    kept = _kept(_shared(_packed(documents, width, parts, _repeated(classes))), at_least, of)
    sets = scratch.keep(kept.dropDuplicates(["key"]).join(classes.select("key", "id"), "key").drop("key"), "sets")

    reach = F.col("n") - F.ceil(F.col("n") * at_least / of) + 1 - F.col("alone")
    index = sets.select("id", "n", "alone", F.posexplode(F.slice("tokens", F.lit(1), F.greatest(reach, F.lit(0)).cast("int")))).select(
        "id", "n", F.col("col").alias("token"), (F.col("pos") + F.col("alone")).alias("pos")
    )
    link = of * F.col("both") >= at_least * (F.col("n_a") + F.col("n_b") - F.col("both"))

    # One leader per list: its first set. Copies of one text propose the same few. Lists of one are done.
    leaders = index.groupBy("token").agg(F.min(F.struct("id", "n", "pos")).alias("m"), F.count("*").alias("length")).filter("length > 1")
    index = scratch.keep(index.join(leaders.drop("length"), "token"), "index")
    proposed = index.filter(F.col("m.id") != F.col("id")).filter(_may_link(at_least, of))
    proposed = proposed.select(F.col("m.id").alias("a"), F.col("id").alias("b")).distinct()
    led = scratch.keep(_overlaps(proposed, sets).filter(link), "led")
    first = scratch.keep(components(led, scratch), "first")
    before, index = None, index.drop("m")
    for turn in range(TURNS):
        index = scratch.keep(_undecided(index, first), "undecided")
        asked = _towards_largest(index, turn, at_least, of)
        if before is not None:
            asked = asked.join(before, ["a", "b"], "left_anti")
        asked = scratch.keep(asked, "asked")
        before = asked if before is None else before.unionByName(asked)
        more = scratch.keep(_overlaps(asked, sets).filter(link), "led")
        if more.isEmpty():
            break
        led = led.unionByName(more)
        first = scratch.keep(components(led.select("a", "b"), scratch), "first")
    # The linked leader that a set has most in common with; ``extra`` counts what it shares with
    # other sets but not with its leader: shingles of its own alone can't add to any overlap.
    best = led.groupBy(F.col("b").alias("id")).agg(
        F.max_by(F.struct(F.col("a").alias("leader"), F.col("rest_b").alias("extra")), F.struct(F.col("both"), -F.col("a"))).alias("_l")
    ).select("id", F.col("_l.leader").alias("leader"), F.col("_l.extra").alias("extra"))
    best = scratch.keep(best, "best")
    sides = scratch.keep(sets.select("id", "n").join(best, "id", "left").join(first.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("leader", "id").alias("leader"), F.coalesce("extra", F.lit(0)).alias("extra"), F.coalesce("component", "id").alias("component")
    ), "sides")

    # |x and s| <= |X and S| + extra(x) + extra(s) for members x, s of leaders X, S. So a link needs
    # (at_least + of) * |X and S| >= need(x) + need(s).
    need = at_least * F.col("n") - (at_least + of) * F.col("extra")
    entries = scratch.keep(_undecided(index, first).drop("component").join(sides, "id").select("token", "id", "n", "pos", "leader", "component", need.alias("need")), "entries")
    block = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(of / at_least)))
    lists = entries.groupBy("token", "leader", "component", block(F.col("n")).alias("block")).agg(
        F.min("need").alias("need"), F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("pos")
    )
    lists = scratch.keep(lists, "lists")
    named = lambda side: lists.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("leader", "component", "need", "low", "high", "pos", "block")])
    # A block meets itself and its neighbours; others are skipped unread.
    probe = named("a").withColumn("block_b", F.explode(F.array(F.col("block_a") - 1, F.col("block_a"), F.col("block_a") + 1)))
    bound = F.least(F.col("high_a") - F.col("pos_a"), F.col("high_b") - F.col("pos_b"))
    met = probe.join(named("b"), ["token", "block_b"]).filter(
        (F.col("component_a") < F.col("component_b"))
        & (of * F.col("high_a") >= at_least * F.col("low_b")) & (of * F.col("high_b") >= at_least * F.col("low_a"))
        & ((at_least + of) * bound >= at_least * (F.col("low_a") + F.col("low_b")))
    )
    met = scratch.keep(met.select("token", "leader_a", "leader_b", "need_a", "need_b"), "met")
    pairs = met.groupBy(F.col("leader_a").alias("a"), F.col("leader_b").alias("b")).agg(F.min(F.col("need_a") + F.col("need_b")).alias("need"))
    pairs = scratch.keep(pairs, "pairs")
    compared = scratch.keep(_overlaps(pairs.select("a", "b"), sets), "compared")
    across = compared.filter(link).select("a", "b")
    open_pairs = compared.filter(~link).join(pairs, ["a", "b"]).select("a", "b", ((at_least + of) * F.col("both")).alias("bound"), "need").filter("bound >= need")
    # Members of open pairs, each where its own need leaves room for the other side's least.
    spots = met.join(open_pairs.select(F.col("a").alias("leader_a"), F.col("b").alias("leader_b"), "bound"), ["leader_a", "leader_b"])
    spots = scratch.keep(spots.filter("need_a + need_b <= bound").groupBy("token", "leader_a", "leader_b", "bound").agg(F.min("need_b").alias("least_b")), "spots")
    side = lambda x: entries.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("leader", "id", "n", "pos", "need")])
    half = scratch.keep(spots.join(side("a"), ["token", "leader_a"]).filter("need_a + least_b <= bound"), "half")
    members = half.join(side("b"), ["token", "leader_b"]).filter(
        (F.col("need_a") + F.col("need_b") <= F.col("bound"))
        & (of * F.col("n_a") >= at_least * F.col("n_b")) & (of * F.col("n_b") >= at_least * F.col("n_a"))
        & ((at_least + of) * F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= at_least * (F.col("n_a") + F.col("n_b")))
    ).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    inner = _overlaps(scratch.keep(members, "members"), sets).filter(link).select("a", "b")
    links = scratch.keep(led.select("a", "b").unionByName(across).unionByName(inner), "links")
    return rows, classes.select("key", "id", "first"), links


def _parts(classes: DataFrame, links: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``key, part`` of every set, and ``part, first`` of every component: its row with the smallest doc_id."""
    named = scratch.keep(components(links, scratch), "components")
    parts = classes.join(named.withColumnRenamed("node", "id"), "id", "left").select("key", "first", F.coalesce("component", "id").alias("part"))
    parts = scratch.keep(parts, "parts")
    return parts.select("key", "part"), scratch.keep(parts.groupBy("part").agg(F.min("first").alias("first")), "names")


def groups(documents: DataFrame, width: int = WIDTH, at_least: int = AT_LEAST, of: int = OF, **options) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``documents (doc_id, text)``.

    Words are ``[^ \\t-\\r]+`` with A-Z lower-cased, of whole texts; a set holds the distinct runs of
    ``width`` words, or the whole sequence where there are fewer. Sets link when ``of * |both| >= at_least * |either|``.
    component_id is the smallest doc_id reachable. Null and empty texts have the empty set and link
    with nothing: their component is their own id. Repeated rows and ids keep their rows. Rows with null ids
    link like others but name no component; it is null where all of its rows have none. Other columns aren't
    read; an empty table gives no rows.
    """
    rows, classes, links = linked(documents, width, at_least, of, **options)
    scratch = Scratch(documents.sparkSession, "groups")
    parts, names = _parts(classes, links, scratch)
    known = scratch.keep(parts.join(names, "part").select("key", F.col("first.doc_id").alias("component_id")), "known")
    joined = rows.join(known, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(documents: DataFrame, **options) -> DataFrame:
    """One row of each component, all columns kept: that with the smallest doc_id, or any where none has one.

    Only rows of one component ever stand for each other: rows under one doc_id, or under none, stay if their texts
    belong to different components. Rows without words are alike to nothing and all stay. Rows of equal
    doc_id are told apart by a 64-bit hash of their text.
    """
    _, classes, links = linked(documents, **options)
    _, names = _parts(classes, links, Scratch(documents.sparkSession, "one-of-each"))
    # Null ids as two columns, so that the join and the last step share one exchange.
    place = ["_no_id", "_id", "_hash"]
    chosen = names.select(F.col("first.no_id").alias("_no_id"), F.coalesce("first.doc_id", F.lit(0)).alias("_id"), F.col("first.text_hash").alias("_hash"))
    worded = F.coalesce(F.col("text").rlike(f"[^{SPACES}]"), F.lit(False))
    # Whole rows in one column, so that no name of theirs can clash.
    rows = documents.filter(worded).select(
        F.struct(*[documents[c] for c in documents.columns]).alias("_row"), documents["doc_id"].isNull().alias("_no_id"),
        F.coalesce(documents["doc_id"].cast("bigint"), F.lit(0)).alias("_id"), F.xxhash64(documents["text"]).alias("_hash"),
    )
    stay = rows.join(chosen, place, "left_semi").dropDuplicates(place).select("_row.*")
    return stay.unionByName(documents.filter(~worded))
