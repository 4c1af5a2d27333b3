"""A trie of conversation prefixes, with totals of subtrees passed from children to parents in time-forward order.

Nodes are distinct prefixes, told by 128-bit hashes. Nodes of a shard are sorted by reverse level order; each is
visited once, takes what its children sent from a priority queue, and sends its own totals on to
its parent's turn. Shards are whole small subtrees; the nodes above them are cut into bands of levels. What the roots
of shards owe to parents elsewhere is added up per parent, passed across the shard roots, and taken into the bands.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheetstar.llm.common import Scratch
from sheetstar.operators.sequence import number_rows

#: A subtree is kept whole in a shard if its conversations have at most so many turns: a share of all, within bounds.
SHARD_SHARE = 1024
LEAST_SHARD = 64
LARGEST_SHARD = 1_000_000
#: Conversations of more turns are numbered in ranges of so many.
HOT_TURNS = 1_000
#: Turns of a conversation whose hashes are joined up in one sort.
BLOCK = 256
#: Messages that a queue holds in memory.
QUEUE_MESSAGES = 500_000
#: Conversation ids that are written as one text before hashing.
PACKED = 10_000


class MessageQueue:
    """A priority queue of ``(key, key, leaves, saved)`` that writes what it can't hold to unnamed files.

    The files are the task's own, as are a sort's; they go with it, and a repeated task makes its own.
    """

    _RECORD = struct.Struct("<4q")

    def __init__(self, limit: int = QUEUE_MESSAGES):
        self.limit = limit
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []
        self.runs: list = []

    def push(self, message: tuple[int, int, int, int]) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        # Sooner messages stay, as they will be asked for first.
        self.heap.sort()
        kept = self.limit // 4
        run = tempfile.TemporaryFile()
        for message in self.heap[kept:]:
            run.write(self._RECORD.pack(*message))
        run.seek(0)
        del self.heap[kept:]
        self.runs.append(run)
        self._advance(len(self.runs) - 1)

    def _advance(self, at: int) -> None:
        record = self.runs[at].read(self._RECORD.size)
        if record:
            heapq.heappush(self.heads, (self._RECORD.unpack(record), at))
        else:
            self.runs[at].close()

    def take(self, key: tuple[int, int]) -> tuple[int, int, int]:
        """Number and sums of all messages with ``key``, which is the least there is or smaller."""
        count = leaves = saved = 0
        while True:
            if self.heap and self.heap[0][:2] == key:
                message = heapq.heappop(self.heap)
            elif self.heads and self.heads[0][0][:2] == key:
                message, at = heapq.heappop(self.heads)
                self._advance(at)
            else:
                return count, leaves, saved
            count, leaves, saved = count + 1, leaves + message[2], saved + message[3]


_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, ends_sha256 string"
_IN = ["top", "own", "more_children", "more_leaves", "more_saved"]


def time_forward(nodes: DataFrame, limit: int = QUEUE_MESSAGES) -> DataFrame:
    """Nodes of each partition with ``n_children, n_leaves, saved_tokens`` of their subtrees there.

    Partitions hold shards, sorted by falling depth, then ``conv_id``. ``top`` marks nodes whose parent is elsewhere;
    ``more_…`` is what children elsewhere have sent.
    """

    def run(batches):
        queue = MessageQueue(limit)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "depth", "parent_conv_id", *_IN)]
            out: list[tuple] = []
            for conv, depth, parent, top, own, children, leaves, saved in zip(*columns):
                count, more_leaves, more_saved = queue.take((-depth, conv))
                children, leaves, saved = children + count, leaves + more_leaves, saved + own + more_saved
                if children == 0:
                    leaves = 1
                out.append((children, leaves, saved))
                if not top:
                    queue.push((1 - depth, parent, leaves, saved))
            kept = [batch.column(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "ends_sha256", "top")]
            totals = [pa.array([o[i] for o in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, *totals], ["conv_id", "depth", "parent_conv_id", "n_convs", "ends_sha256", "top", "n_children", "n_leaves", "saved_tokens"])

    kept = nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "ends_sha256", *_IN)
    return kept.mapInArrow(run, f"{_NODE}, top boolean, n_children bigint, n_leaves bigint, saved_tokens bigint")


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, h1, h2, bytes``: turns by ``turn`` (null first), then role and text, from 1 on in each conversation.

    Null roles and texts are empty; ``h1, h2`` are hashes of both. Rows without ``conv_id`` belong to no conversation.
    """
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").isNotNull().cast("int").alias("dated"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = number_rows(turns, "conv_id", ["dated", "turn", "role", "text"], "pos", hot_rows=HOT_TURNS, range_rows=HOT_TURNS)
    return placed.select(
        "conv_id", "pos", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role", F.lit("second")).alias("h2"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, h1, h2, bytes`` of the conversations that the query's contract makes of numbered turns:
    the first h turns of conversation c - c % 5, then the own turns after the first h. One row of depth 0 each.
    ``length`` is the number of turns of the whole."""
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    each = sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    head = F.least("h", F.coalesce("base_n", F.lit(0)))
    each = each.join(bases, "base", "left").select("conv_id", "base", "h", head.alias("head"), (head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    # At most eight turns of a conversation become others', and of at most five.
    first = turns.filter("pos <= 8").withColumnRenamed("conv_id", "base")
    heads = each.filter("head > 0").join(first, "base").filter("pos <= h").select("conv_id", F.col("pos").alias("depth"), "h1", "h2", "bytes", "length")
    own = turns.join(each, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("depth"), "h1", "h2", "bytes", "length")
    zero = F.lit(0).cast("bigint")
    roots = each.select("conv_id", zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), zero.alias("bytes"), "length")
    return reduce(DataFrame.unionByName, [heads, own, roots])


def _joined_up(rows: DataFrame, values: list[str], place: Column, scratch: Scratch, levels: int = 3) -> DataFrame:
    """``rows`` with each of ``values`` combined (exclusive or) with those at smaller places of its conversation.

    A conversation is sorted in blocks of ``BLOCK`` places; the blocks' own totals are joined up the same way.
    """
    rows = rows.withColumn("_block", F.floor(place / BLOCK).cast("bigint"))
    within = W.partitionBy("conv_id", "_block").orderBy(place)
    local = rows.withColumns({f"_upto_{v}": F.bit_xor(v).over(within) for v in values})
    # Few conversations have a second block.
    totals = rows.groupBy("conv_id", "_block").agg(*[F.bit_xor(v).alias(v) for v in values], F.max("length").alias("length"))
    totals = scratch.keep(totals.filter(F.col("length") >= BLOCK), "blocks")
    if totals.isEmpty():
        return local.select(*[c for c in rows.columns if c not in values and c != "_block"], *[F.col(f"_upto_{v}").alias(v) for v in values])
    totals = totals.withColumn("length", F.floor(F.col("length") / BLOCK).cast("bigint"))
    if levels > 1:
        before = _joined_up(totals.withColumnRenamed("_block", "_at"), values, F.col("_at"), scratch, levels - 1)
    else:
        whole = W.partitionBy("conv_id").orderBy("_block")
        before = totals.select("conv_id", F.col("_block").alias("_at"), *[F.bit_xor(v).over(whole).alias(v) for v in values])
    before = before.select("conv_id", (F.col("_at") + 1).alias("_block"), *[F.col(v).alias(f"_before_{v}") for v in values])
    joined = local.join(before, ["conv_id", "_block"], "left")
    return joined.select(
        *[c for c in rows.columns if c not in values and c != "_block"],
        *[F.col(f"_upto_{v}").bitwiseXOR(F.coalesce(f"_before_{v}", F.lit(0).cast("bigint"))).alias(v) for v in values],
    )


def prefixes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, depth, length, bytes, k1, k2, p1, p2``: hashes of every prefix of every conversation, and of the one before.

    A prefix's hash combines those of its turns, each taken with its place.
    """
    here = F.col("depth") > 0
    own = rows.select(
        "conv_id", "depth", "length", "bytes",
        *[F.when(here, F.xxhash64("h1", "h2", "depth", F.lit(k))).otherwise(F.lit(0).cast("bigint")).alias(f"z{k}") for k in (1, 2)],
    )
    # Written, as both the blocks and their totals are made of it.
    own = scratch.keep(own, "turns").withColumns({"k1": F.col("z1"), "k2": F.col("z2")})
    joined = _joined_up(own, ["k1", "k2"], F.col("depth"), scratch)
    return joined.select("conv_id", "depth", "length", "bytes", "k1", "k2", F.col("k1").bitwiseXOR(F.col("z1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("z2")).alias("p2"))


_KEY = ["depth", "k1", "k2"]


def ends(paths: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256``: the hash of the ids of all conversations that end at a node, ascending.

    Ids are dealt in ranges of the whole order and written as texts of up to ``PACKED`` ids there; a hash is made in
    order by nature, so that of a node is one task's, but reads its few packed texts one after the other.
    """

    def pack(batches):
        key, first, held = None, None, []

        def packed():
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64()) for v in (*key, first)] + [pa.array([",".join(map(str, held))])], [*_KEY, "first", "ids"]
            )

        for batch in batches:
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "conv_id"))):
                if held and (at != key or len(held) >= PACKED):
                    yield packed()
                    held = []
                if not held:
                    key, first = at, conv
                held.append(conv)
        if held:
            yield packed()

    def hash_in_order(batches):
        key, digest = None, None

        def made(found):
            columns = [pa.array(list(c), pa.int64()) for c in zip(*(k for k, _ in found))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([d for _, d in found])], [*_KEY, "ends_sha256"])

        for batch in batches:
            found = []
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids"))):
                if at != key:
                    if key is not None:
                        found.append((key, digest.hexdigest()))
                    key, digest = at, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if found:
                yield made(found)
        if key is not None:
            yield made([(key, digest.hexdigest())])

    ended = paths.filter("depth = length").select(*_KEY, "conv_id")
    texts = ended.repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id").mapInArrow(pack, "depth bigint, k1 bigint, k2 bigint, first bigint, ids string")
    in_order = texts.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return in_order.mapInArrow(hash_in_order, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def _sent(done: DataFrame) -> DataFrame:
    """What the tops of shards send, added up per parent elsewhere: ``at_depth, at_conv, children, leaves, saved``."""
    tops = done.filter("top and depth > 0")
    return tops.groupBy((F.col("depth") - 1).alias("at_depth"), F.col("parent_conv_id").alias("at_conv")).agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )


def _received(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    joined = nodes.join(messages, (F.col("depth") == F.col("at_depth")) & (F.col("conv_id") == F.col("at_conv")), "left")
    add = lambda mine, new: (F.col(mine) + F.coalesce(new, F.lit(0))).alias(mine)
    others = [c for c in nodes.columns if c not in ("more_children", "more_leaves", "more_saved")]
    return joined.select(*others, add("more_children", "children"), add("more_leaves", "leaves"), add("more_saved", "saved"))


def trie(paths: DataFrame, scratch: Scratch, shard: int | None = None, band: int | None = None, queue: int = QUEUE_MESSAGES) -> DataFrame:
    """Nodes of the trie of ``paths`` (see ``prefixes``, written): ``conv_id`` (smallest member), ``depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``shard`` bounds the turns below the root of a shard, ``band`` the levels of a shard of the nodes above these.
    """
    grouped = paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.min("bytes").alias("bytes"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    grouped = scratch.keep(grouped, "groups")
    parents = grouped.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    zero = F.lit(0).cast("bigint")
    nodes = (
        grouped.join(parents, ["depth", "p1", "p2"], "left").join(ends(paths), _KEY, "left")
        .select(
            *_KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "weight",
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("own"), zero.alias("more_children"), zero.alias("more_leaves"), zero.alias("more_saved"),
        )
    )
    nodes = scratch.keep(nodes, "nodes")
    size = nodes.count()
    shard = shard or min(LARGEST_SHARD, max(LEAST_SHARD, size // SHARD_SHARE))
    band = band or max(BLOCK, int(size**0.5))
    # Weights fall along every path, so the nodes above the limit are the top of the trie.
    heavy = nodes.filter(F.col("weight") > shard)
    marked = paths.select("conv_id", *_KEY).join(heavy.select(*_KEY, F.lit(True).alias("above")), _KEY, "left")
    below = F.col("above").isNull()
    shards = marked.filter(below).groupBy("conv_id").agg(F.min("depth").alias("top_depth"), F.min_by(F.struct("k1", "k2"), "depth").alias("shard"))
    light = nodes.filter(F.col("weight") <= shard).join(shards, "conv_id")
    light = light.withColumn("top", F.col("depth") == F.col("top_depth"))
    in_order = light.repartition("shard").sortWithinPartitions(F.desc("depth"), "conv_id")
    done = scratch.keep(time_forward(in_order, queue), "shards")
    above = scratch.keep(_bands(_received(heavy, _sent(done)), paths, band), "bands")
    if not above.isEmpty():
        above = _across(above, scratch, queue)
        done = done.unionByName(above)
    return done.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _bands(heavy: DataFrame, paths: DataFrame, band: int) -> DataFrame:
    """``heavy`` with ``seg_depth, seg1, seg2``, the ancestor where its band of levels begins, and ``top`` for these."""
    at = F.col("depth") - F.col("depth") % band
    starts = paths.filter(F.col("depth") % band == 0).select(F.col("conv_id").alias("_conv"), F.col("depth").alias("seg_depth"), F.col("k1").alias("seg1"), F.col("k2").alias("seg2"))
    placed = heavy.join(starts, (F.col("conv_id") == F.col("_conv")) & (at == F.col("seg_depth"))).drop("_conv")
    return placed.withColumn("top", F.col("depth") == F.col("seg_depth"))


def _across(bands: DataFrame, scratch: Scratch, queue: int) -> DataFrame:
    """Totals of the nodes above the shards: first of the bands' roots, from one to the next, then of all in each band."""
    segment = ["seg_depth", "seg1", "seg2"]
    roots = bands.filter("top")
    if not roots.filter("depth > 0").isEmpty():
        # Inside a band all counts towards its root. A node without children is a leaf.
        inner = bands.filter("depth > 0").groupBy((F.col("depth") - 1).alias("_depth"), F.col("parent_conv_id").alias("_conv")).agg(F.lit(True).alias("_parent")).distinct()
        leaves = bands.join(inner, (F.col("depth") == F.col("_depth")) & (F.col("conv_id") == F.col("_conv")), "left")
        sums = leaves.groupBy(*segment).agg(
            F.sum(F.when(F.col("_parent").isNull() & (F.col("more_children") == 0), 1).otherwise(F.col("more_leaves"))).alias("leaves"),
            F.sum(F.col("own") + F.col("more_saved")).alias("saved"),
        )
        # The band of a root's parent, named by its root.
        owner = bands.select(F.col("depth").alias("_depth"), F.col("conv_id").alias("_conv"), *[F.col(s).alias(f"up_{s}") for s in segment])
        names = roots.select(*segment, F.col("conv_id").alias("up_conv"))
        tree = roots.join(sums, segment).join(owner, (F.col("depth") == F.col("_depth") + 1) & (F.col("parent_conv_id") == F.col("_conv")), "left")
        tree = tree.join(names.select(*[F.col(s).alias(f"up_{s}") for s in segment], "up_conv"), [f"up_{s}" for s in segment], "left")
        # A root of a band is one of a share of the nodes above the shards; they are read in order, one after the other.
        rows = tree.select(
            (F.col("seg_depth")).alias("depth"), "conv_id", "parent_conv_id", "up_seg_depth", "up_conv", "leaves", "saved"
        ).coalesce(1).sortWithinPartitions(F.desc("depth"), "conv_id")
        totals = scratch.keep(rows.mapInArrow(_root_totals(queue), "at_depth bigint, at_conv bigint, leaves bigint, saved bigint"), "roots")
        sent = totals.groupBy("at_depth", "at_conv").agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        bands = _received(bands, sent)
    in_order = bands.repartition(*segment).sortWithinPartitions(F.desc("depth"), "conv_id")
    return time_forward(in_order, queue)


def _root_totals(limit: int):
    """For bands' roots by falling depth: what each sends to its parent, once the roots below have sent theirs."""

    def run(batches):
        queue = MessageQueue(limit)
        for batch in batches:
            out = []
            for depth, conv, parent, up_depth, up_conv, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
                _, more_leaves, more_saved = queue.take((-depth, conv))
                leaves, saved = leaves + more_leaves, saved + more_saved
                if depth > 0:
                    out.append((depth - 1, parent, leaves, saved))
                    queue.push((-up_depth, up_conv, leaves, saved))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], ["at_depth", "at_conv", "leaves", "saved"])

    return run


def build(conversations: DataFrame, **options) -> DataFrame:
    """The trie of the rebuilt conversations of ``conversations (conv_id, turn, role, text)``.

    Rows with null ``conv_id`` are left out; null ``turn`` comes first, ties are by role and text; null role or text is
    empty. Conversations are rebuilt even if they come out without turns: they are members of the root. Repeated rows are
    turns of their own. Other columns aren't read; an empty table gives no node. Equality of prefixes is that of
    128-bit hashes.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.keep(numbered(conversations), "numbered")
    paths = scratch.keep(prefixes(rebuilt(turns), scratch), "paths")
    return trie(paths, scratch, **options)
