"""Near-duplicate vectors by collision-counting projections.

Every unit vector is projected onto many random directions. Two vectors collide in a projection when
they lie within one window of each other; near vectors collide in nearly all. A pair with enough
collisions is verified by its cosine. Window and count are set for a stated recall at the threshold.

Pairs are found without counting all of them: the projections are dealt into groups, one more than a
pair may miss, so a pair with enough collisions has a group in which it collides throughout. The
first projections of a group cut space into cells; a query is sent to the cells its windows touch.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetstar.llm.common import Scratch, components

THRESHOLD = 0.98
PROJECTIONS = 24
GROUPS = 4
#: Chance that a pair right at the threshold has enough collisions.
RECALL = 0.9995
#: Projections of a group that make its cells.
GRID = 2
#: Vectors of a cell are compared in chunks of about this many.
CHUNK = 1_500
#: Candidate pairs that a task looks at together.
STEP = 1_000_000


def needed(projections: int = PROJECTIONS, groups: int = GROUPS) -> int:
    """Collisions that a pair needs: fewer misses than groups."""
    return projections - groups + 1


def window(threshold: float = THRESHOLD, projections: int = PROJECTIONS, groups: int = GROUPS, recall: float = RECALL) -> float:
    """The narrowest window that gives pairs at the threshold enough collisions with chance ``recall``.

    A projected difference is normal with the vectors' distance as its deviation, so the number
    of collisions is binomial.
    """
    distance = math.sqrt(max(2 - 2 * threshold, 1e-12))
    least = needed(projections, groups)

    def reached(w: float) -> float:
        p = math.erf(w / distance / math.sqrt(2))
        return sum(math.comb(projections, k) * p**k * (1 - p) ** (projections - k) for k in range(least, projections + 1))

    low, high = 0.0, 20 * distance
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if reached(middle) >= recall else (middle, high)
    return high


def directions(dimensions: int, projections: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(20_240_607 + dimensions).standard_normal((dimensions, projections))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _links(queries, objects, directions_, width, group, groups, least, threshold):
    """Index pairs (query, object) that this group is the first to find and whose cosine reaches the threshold."""
    uq, uo = _unit(queries), _unit(objects)
    pq, po = uq @ directions_, uo @ directions_
    size = pq.shape[1] // groups
    own = range(group * size, (group + 1) * size)
    # Objects sorted by one projection: a query's window is a stretch of them.
    key = own[-1]
    order = np.argsort(po[:, key])
    line = po[order, key]
    low, high = np.searchsorted(line, pq[:, key] - width), np.searchsorted(line, pq[:, key] + width, side="right")
    counts = high - low
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, side="right")))
        n = counts[at:stop]
        q = np.repeat(np.arange(at, stop), n)
        o = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[at:stop], n)]
        for j in own[:-1]:
            near = np.abs(pq[q, j] - po[o, j]) <= width
            q, o = q[near], o[near]
        near = np.abs(pq[q] - po[o]) <= width
        first = np.ones(len(q), dtype=bool)
        for g in range(group):
            first &= ~near[:, g * size : (g + 1) * size].all(axis=1)
        stay = first & (near.sum(axis=1) >= least)
        q, o = q[stay], o[stay]
        cosine = np.einsum("ij,ij->i", uq[q], uo[o])
        yield q[cosine >= threshold], o[cosine >= threshold]
        at = stop


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the pairs connect, one per node but the smallest of each part."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, projections: int = PROJECTIONS, groups: int = GROUPS, recall: float = RECALL, chunk: int = CHUNK
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors (vec_id, embedding, label)``.

    Vectors of one label link when their cosine, in double precision, is at least ``threshold``;
    n_links counts the other rows linked directly, component_id is the smallest vec_id reachable
    and kept tells whether it is the row's own. Vectors that are null, empty, zero or hold null or
    non-finite components, and those with a null label, link with nothing. Vectors of different
    length don't link. Equal vectors are compared once. Repeated rows count as further vectors, rows
    with null ids count as links but name no component. Other columns aren't read; an empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"), "label")
    good = rows.filter(usable(F.col("v")) & F.col("label").isNotNull())
    # Equal vectors are one, combined before the shuffle however many there are.
    classes = scratch.keep(
        good.groupBy(F.col("label").cast("string").alias("label"), "v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn("id", F.monotonically_increasing_id()), "classes"
    )
    width, least = window(threshold, projections, groups, recall), needed(projections, groups)
    cell = 2 * width

    def sent(batches):
        for batch in batches:
            lengths = np.diff(np.asarray(batch.column("v").offsets))
            for n in np.unique(lengths):
                part = batch.filter(pa.array(lengths == n))
                projected = _unit(_matrix(part.column("v"))) @ directions(int(n), projections)
                size = projections // groups
                for g in range(groups):
                    p = projected[:, g * size : g * size + GRID]
                    home = np.floor(p / cell).astype(np.int64)
                    low, high = np.floor((p - width) / cell).astype(np.int64), np.floor((p + width) / cell).astype(np.int64)
                    targets = [(False, home, np.ones(len(p), dtype=bool))]
                    for corner in product((0, 1), repeat=GRID):
                        take = np.array(corner, dtype=bool)
                        touched = np.where(take, high, low)
                        # A window inside one cell touches it once.
                        targets.append((True, touched, ~((low == high) & take).any(axis=1)))
                    for query, cells, mask in targets:
                        some = part.filter(pa.array(mask))
                        yield pa.RecordBatch.from_arrays(
                            [some.column("id"), some.column("copies"), some.column("label"), some.column("v"), pa.array(np.full(len(some), g, dtype=np.int32)),
                             pa.array([f"{n}:" + ",".join(map(str, c)) for c in cells[mask]], pa.string()), pa.array(np.full(len(some), query))],
                            ["id", "copies", "label", "v", "grp", "cell", "query"],
                        )

    placed = classes.select("id", "copies", "label", "v").mapInArrow(sent, "id bigint, copies bigint, label string, v array<double>, grp int, cell string, query boolean")
    place = ["label", "grp", "cell"]
    sizes = scratch.keep(placed.groupBy(*place).agg(
        F.ceil(F.count_if(~F.col("query")) / chunk).alias("object_chunks"), F.ceil(F.count_if("query") / chunk).alias("query_chunks")
    ).filter("object_chunks > 0 and query_chunks > 0"), "cells")
    # A full cell is compared chunk by chunk: each query chunk meets each object chunk in a task's group.
    spread = placed.join(sizes, place).withColumn(
        "query_chunk", F.when(F.col("query"), F.array(F.pmod(F.xxhash64("id"), "query_chunks"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("query_chunks") - 1))
    ).withColumn(
        "object_chunk", F.when(~F.col("query"), F.array(F.pmod(F.xxhash64("id"), "object_chunks"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("object_chunks") - 1))
    )
    spread = spread.withColumn("query_chunk", F.explode("query_chunk")).withColumn("object_chunk", F.explode("object_chunk")).drop("query_chunks", "object_chunks")

    def compared(table: pa.Table) -> pa.Table:
        query = table.column("query").to_numpy(zero_copy_only=False)
        q, o = table.filter(pa.array(query)), table.filter(pa.array(~query))
        degrees, edges = {}, []
        if len(q) and len(o):
            ids_q, ids_o = q.column("id").to_numpy(), o.column("id").to_numpy()
            copies_q, copies_o = q.column("copies").to_numpy(), o.column("copies").to_numpy()
            vq, vo = _matrix(q.column("v")), _matrix(o.column("v"))
            sums_q, sums_o = np.zeros(len(q), dtype=np.int64), np.zeros(len(o), dtype=np.int64)
            for a, b in _links(vq, vo, directions(vq.shape[1], projections), width, table.column("grp")[0].as_py(), groups, least, threshold):
                once = ids_q[a] < ids_o[b]
                a, b = a[once], b[once]
                np.add.at(sums_q, a, copies_o[b])
                np.add.at(sums_o, b, copies_q[a])
                if len(a):
                    edges.append(_forest(ids_q[a], ids_o[b]))
            for ids, sums in ((ids_q, sums_q), (ids_o, sums_o)):
                for i in np.flatnonzero(sums):
                    degrees[int(ids[i])] = degrees.get(int(ids[i]), 0) + int(sums[i])
        if edges:
            a, b = _forest(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]))
        else:
            a = b = np.empty(0, dtype=np.int64)
        return pa.table({
            "a": pa.array([*degrees, *a.tolist()], pa.int64()), "b": pa.array([*[None] * len(degrees), *b.tolist()], pa.int64()),
            "n": pa.array([*degrees.values(), *[0] * len(a)], pa.int64()),
        })

    found = scratch.keep(spread.groupBy(*place, "query_chunk", "object_chunk").applyInArrow(compared, "a bigint, b bigint, n bigint"), "found")
    degree = found.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    named = components(found.filter("b is not null").select("a", "b"), scratch)
    # Components by class number; their name is the smallest vec_id in them.
    parts = classes.select("id", "first").join(named.withColumnRenamed("node", "id"), "id", "left").select("id", "first", F.coalesce("component", "id").alias("part"))
    parts = scratch.keep(parts, "parts")
    names = parts.groupBy("part").agg(F.min("first").alias("component_id"))
    known = scratch.keep(
        classes.join(parts.select("id", "part"), "id").join(names, "part").join(degree, "id", "left")
        .select("label", "v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known"
    )
    linking = good.select("vec_id", "v", F.col("label").cast("string").alias("label")).join(known, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~(usable(F.col("v")) & F.col("label").isNotNull())).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linking.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
