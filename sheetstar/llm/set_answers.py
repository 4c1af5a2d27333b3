"""All links of the n-gram Jaccard join: a set's answers derived from those of a similar set.

1. Sets, prefixes and index lists are those of ``set_join``. A set joins the group of the linked set, first in one
   of its lists, that it has most in common with; it is then its leader with a few shingles taken out and put in.
2. A list holds one entry per group, size block and position block. Two blocks whose largest sizes and least
   positions leave no room for a link are skipped without reading their sets.
3. The overlap of two leaders is counted once. That of all members follows by what they differ in alone:
   x = L + dx and y = M + dy give x.y = L.M + dx.M + L.dy + dx.dy.

Exact up to equal 64-bit hashes of different shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar.llm import set_join
from sheetstar.llm.common import Scratch, release_memory, small_batches

#: Members of a group that meet those of another at once, on average; columns of their differences held at once.
BLOCK = 64
COLUMNS = 65_536

_PAIRS = "a bigint, b bigint, n_a bigint, n_b bigint, both bigint"
_COUNTS = "id bigint, others bigint"
_MEMBERS = ("id", "n", "copies", "minus", "plus")


def _difference(members: list[dict], columns: np.ndarray) -> np.ndarray:
    """-1 where a member lacks a shingle of its leader, 1 where it has one more; ``columns`` are sorted."""
    found = np.zeros((len(members), len(columns)), dtype=np.float32)
    for i, member in enumerate(members):
        for name, sign in (("minus", -1), ("plus", 1)):
            tokens = np.array(member[name], dtype=np.int64)
            tokens = tokens[(tokens >= columns[0]) & (tokens <= columns[-1])]
            found[i, np.searchsorted(columns, tokens)] = sign
    return found


def _derived(both: int, leader_a: list, leader_b: list, a: list[dict], b: list[dict]) -> np.ndarray:
    """Overlaps of all members ``a`` with all members ``b``, by the overlap of their leaders and the differences."""
    found = np.full((len(a), len(b)), both, dtype=np.int64)
    changed = [m[name] for m in (*a, *b) for name in ("minus", "plus") if m[name]]
    if not changed:
        return found
    columns = np.unique(np.concatenate([np.array(c, dtype=np.int64) for c in changed]))
    in_a, in_b = (np.isin(columns, np.array(x, dtype=np.int64)).astype(np.float32) for x in (leader_a, leader_b))
    for i in range(0, len(columns), COLUMNS):
        part = slice(i, i + COLUMNS)
        of_a, of_b = _difference(a, columns[part]), _difference(b, columns[part])
        # Whole numbers below 2^24 in each part, which the floats hold.
        found += (of_a @ in_b[part]).astype(np.int64)[:, None] + (of_b @ in_a[part]).astype(np.int64)[None, :]
        found += (of_a @ of_b.T).astype(np.int64)
    return found


def _linked(row: dict, at_least: int, of: int):
    """Members of a block and of another, as arrays of ``id, n, copies``, their overlaps and which of them link."""
    a, b = row["members_a"], row["members_b"]
    both = _derived(row["both"], row["leader_a"], row["leader_b"], a, b)
    a, b = ({c: np.array([m[c] for m in side], dtype=np.int64) for c in ("id", "n", "copies")} for side in (a, b))
    link = of * both >= at_least * (a["n"][:, None] + b["n"][None, :] - both)
    if row["same"]:
        link &= a["id"][:, None] < b["id"][None, :]
    return a, b, both, link


def _as_pairs(at_least: int, of: int):
    def run(batches):
        for batch in batches:
            release_memory()
            for row in batch.to_pylist():
                a, b, both, link = _linked(row, at_least, of)
                i, j = np.nonzero(link)
                if not len(i):
                    continue
                swap = a["id"][i] > b["id"][j]
                sides = [(np.where(swap, b[c][j], a[c][i]), np.where(swap, a[c][i], b[c][j])) for c in ("id", "n")]
                columns = [*sides[0], *sides[1], both[i, j]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "n_a", "n_b", "both"])

    return run


def _as_counts(at_least: int, of: int):
    def run(batches):
        for batch in batches:
            release_memory()
            for row in batch.to_pylist():
                a, b, _, link = _linked(row, at_least, of)
                counts = link.astype(np.int64)
                ids, others = np.concatenate([a["id"], b["id"]]), np.concatenate([counts @ b["copies"], a["copies"] @ counts])
                met = others > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[met]), pa.array(others[met])], ["id", "others"])

    return run


def _grouped(index: DataFrame, sets: DataFrame, at_least: int, of: int, scratch: Scratch) -> DataFrame:
    """``id, n, copies, leader, minus, plus, need``: every set with its leader (itself where it has none) and the difference."""
    first = index.groupBy("token").agg(F.min(F.struct("id", "n", "pos")).alias("m"), F.count("*").alias("length")).filter("length > 1")
    proposed = index.join(first.drop("length"), "token").filter((F.col("m.id") != F.col("id")) & set_join._may_link(at_least, of))
    proposed = proposed.select(F.col("m.id").alias("a"), F.col("id").alias("b")).distinct()
    led = set_join._overlaps(proposed, sets).filter(of * F.col("both") >= at_least * (F.col("n_a") + F.col("n_b") - F.col("both")))
    best = led.groupBy(F.col("b").alias("id")).agg(F.max_by("a", F.struct(F.col("both"), -F.col("a"))).alias("leader"))
    best = scratch.keep(best, "best")
    own = sets.select("id", "n", "copies", "tokens").join(best, "id", "left").withColumn("leader", F.coalesce("leader", "id"))
    leading = sets.select(F.col("id").alias("leader"), F.col("tokens").alias("of_leader"))
    both = own.join(leading, "leader")
    plus = F.array_except("tokens", "of_leader")
    # |x and y| <= |L and M| + |plus of x| + |plus of y|, so a link needs (at_least + of) |L and M| >= need(x) + need(y).
    need = at_least * F.col("n") - (at_least + of) * F.size("plus")
    return scratch.keep(
        both.select("id", "n", "copies", "leader", F.array_except("of_leader", "tokens").alias("minus"), plus.alias("plus")).withColumn("need", need), "grouped"
    )


def _leader_pairs(index: DataFrame, grouped: DataFrame, at_least: int, of: int) -> DataFrame:
    """``a, b, need``: leaders (``a <= b``) of groups that may hold linked sets, with the least need of two that met."""
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(of / at_least)))
    entries = index.join(grouped.select("id", "leader", "need"), "id")
    lists = entries.groupBy("token", "leader", size.alias("size"), F.floor(F.log2(F.col("pos") + 1)).alias("place")).agg(
        F.min("need").alias("need"), F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("pos")
    )
    side = lambda x: lists.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("leader", "need", "low", "high", "pos", "size")])
    probe = side("a").withColumn("size_b", F.explode(F.array(F.col("size_a") - 1, F.col("size_a"), F.col("size_a") + 1)))
    left = F.least(F.col("high_a") - F.col("pos_a"), F.col("high_b") - F.col("pos_b"))
    met = probe.join(side("b"), ["token", "size_b"]).filter(
        (F.col("leader_a") < F.col("leader_b"))
        & (of * F.col("high_a") >= at_least * F.col("low_b")) & (of * F.col("high_b") >= at_least * F.col("low_a"))
        & ((at_least + of) * left >= at_least * (F.col("low_a") + F.col("low_b")))
    )
    across = met.groupBy(F.col("leader_a").alias("a"), F.col("leader_b").alias("b")).agg(F.min(F.col("need_a") + F.col("need_b")).alias("need"))
    within = grouped.groupBy("leader").agg(F.count("*").alias("members")).filter("members > 1")
    return across.unionByName(within.select(F.col("leader").alias("a"), F.col("leader").alias("b"), F.lit(None).cast("bigint").alias("need")))


def _met(
    documents: DataFrame, at_least: int, of: int, width: int = set_join.WIDTH,
    group_shingles: int = set_join.GROUP_SHINGLES, block: int = BLOCK,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, met): rows and sets as in ``all_links``, and the blocks of members to compare, with their leaders."""
    small_batches(documents.sparkSession)
    scratch = Scratch(documents.sparkSession, "answers")
    rows = scratch.keep(set_join.own_sets(documents, width), "rows")
    classes = rows.filter("key is not null").groupBy("key").agg(F.max("n_shingles").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("_first"))
    classes = scratch.keep(classes.orderBy("_first", "key").withColumn("id", F.monotonically_increasing_id()).drop("_first"), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    packed = set_join._packed(documents, width, max(1, -(-total // group_shingles)), set_join._repeated(classes))
    kept = set_join._kept(set_join._shared(packed), at_least, of)
    sets = scratch.keep(kept.dropDuplicates(["key"]).join(classes.select("key", "id", "copies"), "key").drop("key"), "sets")
    reach = F.col("n") - F.ceil(F.col("n") * at_least / of) + 1 - F.col("alone")
    index = sets.select("id", "n", "alone", F.posexplode(F.slice("tokens", F.lit(1), F.greatest(reach, F.lit(0)).cast("int"))))
    index = scratch.keep(index.select("id", "n", F.col("col").alias("token"), (F.col("pos") + F.col("alone")).alias("pos")), "index")
    grouped = _grouped(index, sets, at_least, of, scratch)

    leading = lambda x: sets.select(F.col("id").alias(x), F.col("tokens").alias(f"leader_{x}"))
    pairs = scratch.keep(_leader_pairs(index, grouped, at_least, of), "pairs")
    compared = pairs.join(leading("a"), "a").join(leading("b"), "b").withColumn("both", F.size(F.array_intersect("leader_a", "leader_b")).cast("bigint"))
    compared = compared.filter(F.col("need").isNull() | ((at_least + of) * F.col("both") >= F.col("need")))
    # Blocks of a group, of about ``block`` members each, however large it is.
    sizes = grouped.groupBy("leader").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = grouped.join(sizes, "leader").withColumn("place", F.pmod(F.xxhash64("id"), F.col("blocks")))
    blocks = scratch.keep(dealt.groupBy("leader", "place").agg(F.collect_list(F.struct(*_MEMBERS)).alias("members")), "blocks")
    side = lambda x: blocks.select(F.col("leader").alias(x), F.col("place").alias(f"place_{x}"), F.col("members").alias(f"members_{x}"))
    met = compared.join(side("a"), "a").join(side("b"), "b").filter((F.col("a") < F.col("b")) | (F.col("place_a") <= F.col("place_b")))
    met = met.withColumn("same", (F.col("a") == F.col("b")) & (F.col("place_a") == F.col("place_b")))
    return rows, classes.select("key", "id", "n", "copies"), met.select("both", "leader_a", "leader_b", "members_a", "members_b", "same")


def all_links(
    documents: DataFrame, at_least: int = set_join.AT_LEAST, of: int = set_join.OF, **options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): ``doc_id, text_hash, key, n_shingles`` per row of ``documents (doc_id, text)``; ``key, id, n,
    copies`` per distinct set; ``a, b, n_a, n_b, both`` of every two different sets that link, ``a < b``, each once.

    Words and sets are those of ``set_join.groups``. Null and empty texts have no set. Copies of a set aren't expanded:
    they are its ``copies``. The links of n sets that are all alike number n^2 / 2; ``link_counts`` gives no pairs.
    Other columns aren't read; an empty table gives empty results. ``options``: ``width``, ``group_shingles``, and ``block``,
    the members of a group that a task compares at once.
    """
    rows, classes, met = _met(documents, at_least, of, **options)
    return rows, classes, met.mapInArrow(_as_pairs(at_least, of), _PAIRS)


def link_counts(documents: DataFrame, at_least: int = set_join.AT_LEAST, of: int = set_join.OF, **options) -> DataFrame:
    """``doc_id, n_shingles, n_links`` per row: how many other rows it links with, copies of its own text included.

    Rows without words link with nothing. Links are counted in the task that finds them: of two blocks one row per member leaves it.
    """
    rows, classes, met = _met(documents, at_least, of, **options)
    others = met.mapInArrow(_as_counts(at_least, of), _COUNTS).groupBy("id").agg(F.sum("others").alias("others"))
    counted = classes.join(others, "id", "left").select("key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.join(counted, "key", "left").select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"))
