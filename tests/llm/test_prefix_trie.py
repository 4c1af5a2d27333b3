"""The trie against one built from nested dictionaries."""

import hashlib
import random
import zlib

import pytest

from sheetstar.llm import prefix_trie
from sheetstar.llm.common import Scratch

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Rows of ``COLUMNS`` for ``(conv_id, turn, role, text)``."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, len(path)))
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    totals = {}
    for p in sorted(nodes, key=len, reverse=True):
        below = [totals[q] for q in children.get(p, [])]
        own_saved = (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        totals[p] = (sum(b[0] for b in below) or 1, own_saved + sum(b[1] for b in below))
    out = []
    for p, members in nodes.items():
        ended = ",".join(str(c) for c in sorted(c for c, n in members if n == len(p)))
        parent = min(c for c, _ in nodes[p[:-1]]) if p else None
        out.append((min(members)[0], len(p), parent, len(members), len(children.get(p, [])), *totals[p], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: r[:2])


def conversations(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(300), n):
        for t in range(rng.randrange(0, 12)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])))
    return rows


@pytest.mark.parametrize("shard, band", [(None, None), (1, 1), (1, 2), (5, 3), (40, 256), (10**9, 256)])
def test_any_shards_give_the_same_trie(spark, shard, band):
    rows = conversations(shard or 7)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie.build(df, shard=shard, band=band, queue=3)) == brute(rows)


def test_long_and_repeated_conversations(spark):
    """One conversation with many turns, and many copies of another, over several blocks and bands."""
    rows = [(1, t, "user", f"turn {t % 7}") for t in range(3_000)]
    rows += [(c, t, "user", "same") for c in range(100, 160) for t in range(10)]
    rows += [(5, t, "user", "same") for t in range(700)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert found(prefix_trie.build(df, shard=50, band=256)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (7, None, None, None), (7, None, None, None), (7, 2, "user", "x" * 100_000), (8, 0, "a", "\u0000"), (0, 5, "", "")]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], f"{SCHEMA}, depth int, k1 string")
    assert found(prefix_trie.build(df)) == brute(rows)
    assert found(prefix_trie.build(df.limit(0))) == []


def test_separators_do_not_join_role_and_text(spark):
    rows = [(10, 0, "ab", "c"), (11, 0, "a", "bc"), (12, 0, "ab", "c")]
    assert found(prefix_trie.build(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_ids_are_packed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PACKED", 7)
    rows = [(c, 0, "user", "same") for c in range(1, 200)]
    assert found(prefix_trie.build(spark.createDataFrame(rows, SCHEMA).repartition(6))) == brute(rows)


def test_queue_spills_and_keeps_its_order():
    rng = random.Random(3)
    queue = prefix_trie.MessageQueue(8)
    sent = [(rng.randrange(-20, 0), rng.randrange(5), rng.randrange(10), rng.randrange(10)) for _ in range(500)]
    for message in sent:
        queue.push(message)
    assert len(queue.heap) <= 8 and queue.runs
    for key in sorted({m[:2] for m in sent}):
        mine = [m for m in sent if m[:2] == key]
        assert queue.take(key) == (len(mine), sum(m[2] for m in mine), sum(m[3] for m in mine))
    assert queue.take((0, 0)) == (0, 0, 0)


def test_whole_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(prefix_trie.build(df)) == brute(rows)


def test_prefix_hashes_do_not_depend_on_blocks(spark, monkeypatch):
    rows = conversations(11)
    df = spark.createDataFrame(rows, SCHEMA)

    def hashes():
        scratch = Scratch(spark, "test")
        return {(r.conv_id, r.depth): (r.k1, r.k2, r.p1, r.p2) for r in prefix_trie.prefixes(prefix_trie.rebuilt(prefix_trie.numbered(df)), scratch).collect()}

    whole = hashes()
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    assert hashes() == whole
