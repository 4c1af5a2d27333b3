"""Mixing sources to target weights by entropy balancing.

A document of size x gets the rate ``min(CAP, exp(lambda * x / scale))``, with one multiplier per
source: of all rates between 0 and ``CAP`` that meet the source's word target, these lie nearest to
one copy each in relative entropy. Newton iterations find the multipliers; rates then become copies.

Rates depend on (source, size) alone, so everything after one pass over the documents works on the
cells of that histogram, and the decision of a document on its id, source and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheetstar.llm.common import SPACES, Scratch
from sheetstar.operators.sequence import number_rows

#: Weights of the sources in order, repeated; the share of all words that the mix takes.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
#: No document counts more often than this.
CAP = 2.0
#: A multiplier is found when its source's words are off by less than this share.
TOLERANCE = 1e-8
#: The bracket halves whenever a Newton step leaves it, so fewer rounds do; beyond these the mix fails rather than miss a target.
MAX_ROUNDS = 200
#: Rows that share id, source and size are numbered in ranges of so many.
SHARED_ROWS = 16_384
#: Ids of a cell are ranked in chunks of about this many.
CHUNK = 128
#: Size classes for each doubling of the size; they bound what is rounded in sequence.
CLASSES = 16


def size_of(text: Column) -> Column:
    """Words ``[^ \\t-\\r]+`` of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("bigint")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(sources: DataFrame, share: float = SHARE, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """``target`` for ``sources (_key, source, words)``, one row per source.

    Weighted shares are cut at ``cap`` times the source's words and the excess goes to the others by
    weight. In the order of cap by weight the cut ones come first, so running sums replace the
    repeated resharing. One row per source is ordered here, never documents.
    """
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    every = W.partitionBy()
    rows = sources.withColumn("_weight", weight).withColumn("_most", cap * F.col("words"))
    rows = rows.withColumn("_all", share * F.sum("words").over(every)).withColumn("_ratio", F.col("_most") / F.col("_weight"))
    by_ratio = W.orderBy("_ratio", "_key")
    before = F.coalesce(F.sum("_most").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("_cut", F.col("_most") * rest <= F.col("_weight") * (F.col("_all") - before))
    kept = F.sum(F.when(F.col("_cut"), 0.0).otherwise(F.col("_weight"))).over(every)
    spent = F.sum(F.when(F.col("_cut"), F.col("_most")).otherwise(0.0)).over(every)
    level = F.col("_weight") * (F.col("_all") - spent) / F.nullif(kept, F.lit(0.0))
    return rows.withColumn("target", F.when(F.col("_cut"), F.col("_most")).otherwise(level)).drop("_weight", "_most", "_all", "_ratio", "_cut")


def _rate(multiplier: Column, x: Column, cap: float) -> Column:
    return F.least(F.lit(cap), F.exp(F.least(multiplier * x, F.lit(50.0))))


def multipliers(cells: DataFrame, wanted: DataFrame, scratch: Scratch, cap: float = CAP) -> DataFrame:
    """``_key, multiplier, scale`` for each source with words below its cap.

    Each round is one aggregation of the histogram by source (combined before the shuffle) that
    gives the words taken and their derivative; a step is Newton's, or halves the bracket where
    Newton's leaves it. ``cells`` has ``_key, size, n``; ``wanted`` has ``_key, target, words, scale``.
    """
    state = scratch.keep(
        wanted.filter((F.col("words") > 0) & (F.col("target") < cap * F.col("words"))).select(
            "_key", "target", "scale", F.log(F.col("target") / F.col("words")).alias("multiplier"),
            F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(False).alias("done"),
        ),
        "multipliers",
    )
    rounds = 0
    while not state.filter("not done").isEmpty():
        rounds += 1
        if rounds > MAX_ROUNDS:
            raise RuntimeError(f"multipliers not found in {MAX_ROUNDS} rounds: {[r['_key'] for r in state.filter('not done').select('_key').limit(10).collect()]}")
        x, m = F.col("size") / F.col("scale"), F.col("multiplier")
        rate, words = _rate(m, x, cap), F.col("n") * F.col("size")
        taken = cells.join(state.filter("not done").select("_key", "scale", "multiplier"), "_key").groupBy("_key").agg(
            F.sum(words * rate).alias("taken"), F.sum(F.when(m * x < F.log(F.lit(cap)), words * rate * x).otherwise(0.0)).alias("slope")
        )
        over = F.col("taken") > F.col("target")
        stepped = (
            state.join(taken, "_key", "left")
            .withColumn("low", F.when(over | F.col("done"), F.col("low")).otherwise(m))
            .withColumn("high", F.when(over & ~F.col("done"), m).otherwise(F.col("high")))
            .withColumn("_step", m + (F.col("target") - F.col("taken")) / F.nullif(F.col("slope"), F.lit(0.0)))
            .withColumn("_found", F.col("done") | (F.abs(F.col("taken") - F.col("target")) <= TOLERANCE * F.col("target")) | (F.col("high") - F.col("low") < 1e-12))
        )
        inside = (F.col("_step") > F.col("low")) & (F.col("_step") < F.col("high"))
        half = F.greatest(F.least((F.col("low") + F.col("high")) / 2, m + 4), m - 4)
        previous = state
        state = scratch.keep(
            stepped.select(
                "_key", "target", "scale",
                F.when(F.col("_found"), m).otherwise(F.when(inside, F.greatest(F.least(F.col("_step"), m + 4), m - 4)).otherwise(half)).alias("multiplier"),
                "low", "high", F.col("_found").alias("done"),
            ),
            "multipliers",
        )
        scratch.drop(previous)
    return state.select("_key", "multiplier", "scale")


def _extras(rated: DataFrame) -> DataFrame:
    """``extra`` for each cell: how many of its documents get one copy above the whole part of the rate.

    From large sizes to small, each class of nearly equal size and rate takes as many extra copies
    as bring the source's words nearest to their target so far; so the words still owed or overdrawn
    end below the size of the smallest classes. Inside a class the copies are spread evenly.
    """
    part = F.col("rate") - F.floor("rate")
    rated = rated.withColumn("_part", part * F.col("n")).withColumn(
        "_class", (F.floor(F.log2(F.col("size").cast("double")) * CLASSES) * 4 + F.floor("rate")).cast("bigint")
    )
    classes = rated.groupBy("_key", "_class").agg(
        F.sum("_part").alias("part"), F.sum(F.col("_part") * F.col("size")).alias("words"), F.sum("n").alias("n")
    )
    in_order = classes.groupBy("_key").agg(
        F.sort_array(F.collect_list(F.struct("_class", "part", "words", "n")), asc=False).alias("_all")
    )

    def take(done, c):
        mean = F.when(c["part"] > 0, c["words"] / c["part"]).otherwise(F.lit(1.0))
        owed = done["owed"] + c["words"]
        k = F.when(c["part"] > 0, F.greatest(F.lit(0), F.least(c["n"], F.round(owed / mean).cast("bigint")))).otherwise(F.lit(0)).cast("bigint")
        return F.struct((owed - k * mean).alias("owed"), F.concat(done["taken"], F.array(F.struct(c["_class"].alias("_class"), k.alias("k")))).alias("taken"))

    start = F.struct(F.lit(0.0).alias("owed"), F.expr("cast(array() as array<struct<_class: bigint, k: bigint>>)").alias("taken"))
    per_class = in_order.select("_key", F.explode(F.aggregate("_all", start, take)["taken"]).alias("_t")).select("_key", "_t._class", "_t.k")
    before = W.partitionBy("_key", "_class").orderBy("size")
    whole = W.partitionBy("_key", "_class")
    spread = rated.join(per_class, ["_key", "_class"]).withColumn("_share", F.col("k") / F.nullif(F.sum("_part").over(whole), F.lit(0.0)))
    upto = F.round(F.sum("_part").over(before) * F.col("_share"), 6)
    after = spread.withColumn("_to", F.floor(upto + 0.5))
    return after.withColumn("extra", F.least(F.col("n"), F.coalesce(F.col("_to") - F.coalesce(F.lag("_to").over(before), F.lit(0)), F.lit(0))).cast("bigint")).drop("_part", "_class", "k", "_share", "_to")


def _numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows (doc_id, _key, size, _text)`` with ``_nth``, from 1 on among rows that share id, source and size, by text hash.

    Rows that also share their text are interchangeable, so another run may swap them and gives the same table.
    """
    shared_by = F.xxhash64("doc_id", "_key", "size")
    rows = rows.withColumn("_shared", shared_by)
    shared = scratch.keep(rows.groupBy("_shared").agg(F.count("*").alias("_rows")).filter("_rows > 1").select("_shared"), "shared")
    if shared.isEmpty():
        return rows.drop("_shared").withColumn("_nth", F.lit(1).cast("bigint"))
    alone = rows.join(shared, "_shared", "left_anti").withColumn("_nth", F.lit(1).cast("bigint"))
    numbered = number_rows(rows.join(shared, "_shared", "left_semi"), "_shared", ["_text"], "_nth", hot_rows=SHARED_ROWS, range_rows=SHARED_ROWS)
    return alone.unionByName(numbered).drop("_shared")


def mix(documents: DataFrame, share: float = SHARE, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``documents``.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn; together they take
    ``share`` of all words, none more than ``cap`` times its own. A null text has size 0 and is
    taken once; a null source is a source. Rows that share id, source and size are told apart by a number in the
    order of their texts' hashes, so targets are met however many share an id, and reruns agree: equal rows may
    get different copies, the same ones each time. Other columns aren't read; an empty table gives no rows.
    """
    decided = _decided(documents, Scratch(documents.sparkSession, "mixing"), share, weights, cap)
    return decided.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def rates(documents: DataFrame, share: float = SHARE, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """``source, size, n, rate``: the rate of every (source, size) cell, before rounding to copies."""
    scratch = Scratch(documents.sparkSession, "mixing")
    sized = scratch.keep(documents.select("source", _key(F.col("source")).alias("_key"), size_of(F.col("text")).alias("size")), "sizes")
    cells, _, rated = _rated(sized, scratch, share, weights, cap)
    return rated.join(cells.select("_key", "size", "source"), ["_key", "size"]).select("source", "size", "n", "rate")


def _rated(sized: DataFrame, scratch: Scratch, share: float, weights, cap: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cells ``_key, source, size, n``, targets by source, and ``_key, size, n, rate``."""
    cells = scratch.keep(sized.groupBy("_key", "source", "size").agg(F.count("*").alias("n")), "cells")
    words, squares = F.sum(F.col("n") * F.col("size")), F.sum(F.col("n") * F.col("size") * F.col("size"))
    sources = cells.groupBy("_key", "source").agg(words.alias("words"), (squares / F.nullif(words, F.lit(0))).alias("scale"))
    wanted = scratch.keep(targets(sources, share, weights, cap), "targets")
    found = multipliers(cells, wanted, scratch, cap)
    full = F.when(F.col("words") > 0, F.lit(cap)).otherwise(F.lit(1.0))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.coalesce(_rate(F.col("multiplier"), F.col("size") / F.col("scale"), cap), full))
    rated = cells.select("_key", "size", "n").join(wanted.select("_key", "words"), "_key").join(found, "_key", "left").select("_key", "size", "n", rate.alias("rate"))
    return cells, wanted, rated


def _decided(documents: DataFrame, scratch: Scratch, share: float, weights, cap: float) -> DataFrame:
    """Each row's ``doc_id, source, _key, size, _nth, copies, source_size, target``."""
    sized = scratch.keep(
        documents.select("doc_id", "source", _key(F.col("source")).alias("_key"), size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("_text")), "sizes"
    )
    _, wanted, rated = _rated(sized, scratch, share, weights, cap)
    empty = rated.filter("size = 0").withColumn("extra", F.lit(0).cast("bigint"))
    plan = scratch.keep(_extras(rated.filter("size > 0")).select(empty.columns).unionByName(empty), "plan")
    # Which ids of a cell get the extra copy: the lowest hashes, in chunks so that no large cell meets in one task.
    chunks = F.ceil(F.col("n") / CHUNK)
    turn = lambda use: F.when(F.col("_nth") == 1, F.xxhash64("doc_id", F.lit(use))).otherwise(F.xxhash64("doc_id", F.lit(use), "_nth"))
    numbered = _numbered(sized, scratch).drop("_text")
    placed = numbered.join(plan, ["_key", "size"]).withColumn("_chunk", F.pmod(turn("chunk"), chunks)).withColumn("_hash", turn("extra"))
    counts = placed.filter("extra > 0 and extra < n").groupBy("_key", "size", "_chunk", "n", "extra").agg(F.count("*").alias("_in"), F.sort_array(F.collect_set("_hash")).alias("_hashes"))
    upto = F.floor(F.sum("_in").over(W.partitionBy("_key", "size").orderBy("_chunk")) * F.col("extra") / F.col("n") + 0.5)
    # try_element_at would read from the end for 0, so that case is told apart.
    limits = (
        counts.withColumn("_to", upto)
        .withColumn("_take", (F.col("_to") - F.coalesce(F.lag("_to").over(W.partitionBy("_key", "size").orderBy("_chunk")), F.lit(0))).cast("int"))
        .select("_key", "size", "_chunk", F.when(F.col("_take") > 0, F.element_at("_hashes", F.least("_take", F.size("_hashes")))).alias("_limit"))
    )
    limits = scratch.keep(limits, "limits")
    one_more = F.when(F.col("extra") >= F.col("n"), F.lit(1)).otherwise(F.coalesce((F.col("_hash") <= F.col("_limit")).cast("int"), F.lit(0)))
    one_more = F.when(F.col("extra") == 0, F.lit(0)).otherwise(one_more)
    decided = placed.join(limits, ["_key", "size", "_chunk"], "left").withColumn("copies", (F.floor("rate") + one_more).cast("bigint"))
    return decided.join(wanted.select("_key", F.col("words").alias("source_size"), "target"), "_key").select(
        "doc_id", "source", "_key", "size", "_nth", "copies", "source_size", "target"
    )


def repeat(documents: DataFrame, share: float = SHARE, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """``documents`` with each row as often as the mix takes it, all columns kept."""
    scratch = Scratch(documents.sparkSession, "mixing")
    decided = _decided(documents, scratch, share, weights, cap).filter("copies > 0").select(
        F.col("doc_id").alias("id"), F.col("_key").alias("key"), F.col("size").alias("of_size"), F.col("_nth").alias("nth"), "copies"
    )
    # Whole rows in one column, so that no name of theirs can clash.
    rows = documents.select(
        F.struct(*[documents[c] for c in documents.columns]).alias("row"), documents["doc_id"].alias("doc_id"),
        _key(documents["source"]).alias("_key"), size_of(documents["text"]).alias("size"), F.xxhash64(documents["text"]).alias("_text"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")) & (F.col("size") == F.col("of_size")) & (F.col("_nth") == F.col("nth"))
    each = _numbered(rows, scratch).join(decided, same).select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return each.select("row.*")
