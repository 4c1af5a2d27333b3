"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths, max pooling.

All labelled documents are learned from. A bounded draw of them gives the weights to start from, fitted in numpy on the
driver; Spark counts the words of all, tasks go through all of them from the same weights and their results are
averaged, and all documents that are kept back for it set the decision thresholds, for each language, as told from
the words alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar.llm.common import Scratch, held_out
from sheetstar.llm.words import WordHasher, chunks, text_buffers

#: Bounds of the draw that gives the first weights: documents of each class to train on, documents to set thresholds on.
TRAIN_TOXIC, TRAIN_CLEAN, CALIBRATE = 4_000, 5_000, 5_000
#: Hash buckets of words; those in fewer documents than LEAST_DOCS share one row, at most ROWS have their own.
BUCKETS = 1 << 18
LEAST_DOCS = 3
ROWS = 60_000
DIMENSIONS = 16
WIDTHS = (1, 2, 3)
FILTERS = 24
EPOCHS = 8
#: Small samples are gone through more often.
LEAST_STEPS = 400
BATCH = 64
RATE = 0.003
DECAY = 1e-4
#: Words of a drawn text's beginning and of its end that the first weights are learned from. All later steps read whole texts.
SAMPLE_WORDS = 10_000
#: How often all documents are gone through, each time from the averaged weights of the time before.
PASSES = 3
#: Words that one set of weights is trained on in a pass; a task with more trains several, each from the same weights.
REPLICA_WORDS = 4_000_000
#: Rows of words that are averaged together.
BLOCK_ROWS = 1_024
#: Logits are counted in steps of this size, up to LARGEST_LOGIT either way, to set thresholds by.
LOGIT_STEP = 1 / 256
LARGEST_LOGIT = 64
LANGUAGES = 64
#: A language with fewer toxic documents to set its threshold on takes the one of all.
LEAST_TOXIC = 25
#: Words scored together.
STEP_WORDS = 200_000

#: ASCII other than letters and digits separates words.
_SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _buckets(column, hasher: WordHasher):
    """Buckets of the words of every text of an Arrow column, and where each text's begin."""
    offsets, data = text_buffers(column)
    for i, j in chunks(offsets):
        words, at = hasher.words(data, offsets[i:j], offsets[i + 1 : j + 1])
        yield i, (words & np.uint64(BUCKETS - 1)).astype(np.int32), at


@dataclass
class Network:
    """``row`` maps a bucket to its row of ``words`` (0: the shared one; the last: padding, always zero)."""

    row: np.ndarray
    words: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    language: np.ndarray
    thresholds: np.ndarray

    def pooled(self, ids: np.ndarray, at: np.ndarray):
        """Largest response of each filter in each text, and the padded rows. ``ids``: rows of all texts in a line."""
        padded, starts, ends = _padded(ids, at, len(self.words) - 1)
        x = self.words[padded]
        stretches = np.stack([starts, ends], axis=1).ravel()
        best = []
        for width, weights, biases in zip(WIDTHS, self.filters, self.biases):
            n = len(padded) - width + 1
            z = np.zeros((n, FILTERS), dtype=np.float32)
            for k in range(width):
                z += x[k : k + n] @ weights[k]
            best.append(np.maximum(np.maximum.reduceat(z, stretches)[::2] + biases, 0))
        return np.concatenate(best, axis=1)

    def logits(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.pooled(ids, at) @ self.out + self.bias


def _padded(ids: np.ndarray, at: np.ndarray, pad: int):
    """The rows of all texts with paddings after each, and where each text's windows begin and end.

    A window begins at a word (in an empty text at its first padding) and so never reaches the next text.
    """
    gap = max(WIDTHS)
    n = len(at) - 1
    lengths = np.diff(at)
    out = np.full(len(ids) + gap * (n + 1), pad, dtype=np.int64)
    out[np.arange(len(ids)) + gap * np.repeat(np.arange(n), lengths)] = ids
    starts = at[:-1] + gap * np.arange(n)
    return out, starts, starts + np.maximum(lengths, 1)


def _winners(z_of, start: int, end: int) -> np.ndarray:
    """Where each filter responds most from ``start`` to ``end``; a long text's responses are never held all at once."""
    best, where = None, None
    for a in range(start, end, STEP_WORDS):
        z = z_of(a, min(a + STEP_WORDS, end))
        at = z.argmax(axis=0)
        top = z[at, np.arange(FILTERS)]
        if best is None:
            best, where = top, a + at
        else:
            where = np.where(top > best, a + at, where)
            best = np.maximum(best, top)
    return where


def _gradients(p: dict[str, np.ndarray], ids: np.ndarray, at: np.ndarray, labels: np.ndarray, weight: np.ndarray, r) -> dict[str, np.ndarray]:
    """Gradients of the weighted logistic loss of some texts; only the winning windows of the pooling pass one on.

    The first and last row of ``p["e"]`` (the shared one, the padding) stay zero.
    """
    pad = len(p["e"]) - 1
    padded, starts, ends = _padded(ids, at, pad)
    long = len(padded) > 2 * STEP_WORDS
    x = None if long else p["e"][padded]
    features, winners = [], []
    for width in WIDTHS:
        n = len(padded) - width + 1
        filters = p[f"w{width}"]
        if long:
            def z_of(a, b):
                rows = p["e"][padded[a : b + width - 1]]
                return sum(rows[k : k + b - a] @ filters[k] for k in range(width))

            where = np.stack([_winners(z_of, s, e) for s, e in zip(starts, ends)])
            responses = sum(np.einsum("tfd,df->tf", p["e"][padded[where + k]], filters[k]) for k in range(width))
        else:
            z = sum(x[k : k + n] @ filters[k] for k in range(width))
            where = np.stack([s + z[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
            responses = np.take_along_axis(z, where, axis=0)
        winners.append(where)
        features.append(responses + p[f"c{width}"])
    raw = np.concatenate(features, axis=1)
    h = np.maximum(raw, 0)
    drop = (r.random(h.shape) < 0.8).astype(np.float32) / 0.8
    z = (h * drop) @ p["o"] + p["b"]
    g = weight * (1 / (1 + np.exp(-z)) - labels) / len(labels)
    grads = {k: DECAY * v for k, v in p.items()}
    grads["o"] = grads["o"] + (h * drop).T @ g
    grads["b"] = np.array([g.sum()], dtype=np.float32)
    back = g[:, None] * p["o"] * drop * (raw > 0)
    for f, (width, where) in enumerate(zip(WIDTHS, winners)):
        d = back[:, f * FILTERS : (f + 1) * FILTERS]
        grads[f"c{width}"] = grads[f"c{width}"] + d.sum(axis=0)
        for k in range(width):
            at_k = padded[where + k]
            grads[f"w{width}"][k] += np.einsum("df,dfe->ef", d, p["e"][at_k])
            np.add.at(grads["e"], at_k, d[:, :, None] * p[f"w{width}"][k].T[None])
    grads["e"][[0, pad]] = 0
    return grads


class Adam:
    """Adam on the arrays of ``p``, which it replaces."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.steps = p, 0
        self.first, self.second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))

    def step(self, grads: dict[str, np.ndarray]) -> None:
        p, first, second = self.p, self.first, self.second
        self.steps += 1
        for k in p:
            first[k] += 0.1 * (grads[k] - first[k])
            second[k] += 0.001 * (grads[k] ** 2 - second[k])
            p[k] = p[k] - RATE * (first[k] / (1 - 0.9**self.steps)) / (np.sqrt(second[k] / (1 - 0.999**self.steps)) + 1e-8)


def train(sample: list[tuple[np.ndarray, int, int]], calibrate: list[tuple[np.ndarray, int, int]], languages: int, seed: int = 7) -> Network | None:
    """Fit on ``(buckets, toxic, language)`` of documents; None if a class is missing.

    Adam on the logistic loss; only the winning windows of the pooling pass a gradient on. One
    document in ten tells after which epoch the network was best.
    """
    labels = np.array([y for _, y, _ in sample], dtype=np.float32)
    if len(sample) == 0 or labels.min() == labels.max():
        return None
    r = np.random.default_rng(seed)
    seen = np.zeros(BUCKETS, dtype=np.int64)
    for words, _, _ in sample:
        seen[np.unique(words)] += 1
    own = np.flatnonzero(seen >= min(LEAST_DOCS, max(1, len(sample) // 20)))
    own = own[np.argsort(-seen[own], kind="stable")][:ROWS]
    row = np.zeros(BUCKETS, dtype=np.int32)
    row[own] = np.arange(1, len(own) + 1)
    pad = len(own) + 1
    by_language = np.full((len(own) + 2, max(1, languages)), 1.0)
    for words, _, language in sample:
        if language >= 0:
            np.add.at(by_language[:, language], row[words], 1)
    by_language[[0, pad]] = 1
    by_language = np.log(by_language / by_language.sum(axis=0))
    by_language[[0, pad]] = 0

    def fresh(*shape):
        return r.normal(0, 0.1, shape).astype(np.float32)

    p = {"e": fresh(len(own) + 2, DIMENSIONS), "o": fresh(FILTERS * len(WIDTHS)), "b": np.zeros(1, dtype=np.float32)}
    p["e"][[0, pad]] = 0
    for width in WIDTHS:
        p[f"w{width}"] = (fresh(width, DIMENSIONS, FILTERS) * 3).astype(np.float32)
        p[f"c{width}"] = np.zeros(FILTERS, dtype=np.float32)
    texts = [row[words] for words, _, _ in sample]
    order = r.permutation(len(texts))
    check, rest = order[: max(1, len(order) // 10)], order[max(1, len(order) // 10) :]
    if len(rest) == 0:
        rest = order
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9)).astype(np.float32)

    def network(q) -> Network:
        return Network(row, q["e"], [q[f"w{w}"] for w in WIDTHS], [q[f"c{w}"] for w in WIDTHS], q["o"], float(q["b"][0]), by_language.astype(np.float32), np.zeros(max(1, languages)))

    def line(members):
        at = np.concatenate([[0], np.cumsum([len(texts[i]) for i in members])])
        return np.concatenate([texts[i] for i in members]).astype(np.int64), at

    def loss_of(q, members):
        total = 0.0
        for i in range(0, len(members), BATCH):
            some = members[i : i + BATCH]
            z = network(q).logits(*line(some)) * (2 * labels[some] - 1)
            total += float((weight[some] * np.logaddexp(0, -z)).sum())
        return total

    best, kept = np.inf, None
    adam = Adam(p)
    for _ in range(max(EPOCHS, LEAST_STEPS * BATCH // len(rest))):
        r.shuffle(rest)
        for i in range(0, len(rest), BATCH):
            some = rest[i : i + BATCH]
            adam.step(_gradients(p, *line(some), labels[some], weight[some], r))
        now = loss_of(p, check)
        if now < best:
            best, kept = now, {k: v.astype(np.float32) for k, v in p.items()}
    made = network(kept if kept is not None else p)
    made.thresholds = _thresholds(made, calibrate or sample, languages)
    return made


def _best_cut(logits: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the best F1, half way between neighbouring logits."""
    order = np.argsort(-logits, kind="stable")
    z, y = logits[order], toxic[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][z[:-1] == z[1:]] = -1
    k = int(np.argmax(f1))
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k] - 1)


def _thresholds(made: Network, rows, languages: int) -> np.ndarray:
    logits, guessed, toxic = [], [], np.array([y for _, y, _ in rows])
    for words, _, _ in rows:
        ids = made.row[words].astype(np.int64)
        at = np.array([0, len(ids)])
        logits.append(float(made.logits(ids, at)[0]))
        guessed.append(int(_languages(made, ids, at)[0]))
    logits, guessed = np.array(logits), np.array(guessed)
    every = _best_cut(logits, toxic) if toxic.any() else float(logits.max()) + 1
    cuts = np.full(max(1, languages), every)
    for k in range(languages):
        mine = guessed == k
        if toxic[mine].sum() >= LEAST_TOXIC and not toxic[mine].all():
            cuts[k] = _best_cut(logits[mine], toxic[mine])
    return cuts


def _languages(made: Network, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The language whose words a text's are likeliest from."""
    sums = np.zeros((len(ids) + 1, made.language.shape[1]))
    np.cumsum(made.language[ids], axis=0, out=sums[1:])
    return np.argmax(sums[at[1:]] - sums[at[:-1]], axis=1)


def scores(made: Network | None, column) -> np.ndarray:
    """Score of every text of an Arrow column: 0.5 or more where the logit reaches its language's threshold."""
    out = np.zeros(len(column))
    if made is None:
        return out
    hasher = WordHasher(_SEPARATORS)
    for i, words, at in _buckets(column, hasher):
        ids = made.row[words].astype(np.int64)
        a = 0
        while a < len(at) - 1:
            b = max(a + 1, int(np.searchsorted(at, at[a] + STEP_WORDS, side="right")) - 1)
            b = min(b, len(at) - 1)
            some, bounds = ids[at[a] : at[b]], at[a : b + 1] - at[a]
            z = made.logits(some, bounds) - made.thresholds[_languages(made, some, bounds)]
            out[i + a : i + b] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            a = b
    return out


def _bincut(bins: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> float:
    """The cut with the best F1 of documents counted by their logit's step, half way between neighbouring ones."""
    order = np.argsort(-bins, kind="stable")
    z, hits, n = bins[order] * LOGIT_STEP, np.cumsum(toxic[order]), np.cumsum(rows[order])
    k = int(np.argmax(2 * hits / (n + hits[-1])))
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k] - 1)


def _features(documents: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, toxic, part, lang, text_hash, words`` (buckets of all words) of every document that is ``known``."""
    def hashed(batches):
        hasher = WordHasher(_SEPARATORS)
        for batch in batches:
            words = [None] * batch.num_rows
            for i, found, at in _buckets(batch.column("text"), hasher):
                for k in range(len(at) - 1):
                    words[i + k] = found[at[k] : at[k + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(words, pa.binary())], [*kept, "words"])

    kept = ["doc_id", "toxic", "part", "lang", "text_hash"]
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", F.xxhash64("text").alias("text_hash"))
    return texts.join(known, "doc_id").select(*kept, "text").mapInArrow(hashed, "doc_id bigint, toxic int, part int, lang string, text_hash bigint, words binary")


def _start(rows: DataFrame, turn, place: dict[str, int]) -> Network | None:
    """The first weights, fitted on the driver.

    Ids are drawn by hash, up to the bounds above; only their documents are collected, one row per id (of several that
    share it, the one with the least hash of its text), with at most ``SAMPLE_WORDS`` words from each end of a text: so
    what reaches the driver is bounded.
    """
    ids = rows.select("doc_id", "toxic", "part").distinct()
    drawn = [
        ids.filter(condition).orderBy(turn).limit(n)
        for condition, n in (("part = 0 and toxic = 1", TRAIN_TOXIC), ("part = 0 and toxic = 0", TRAIN_CLEAN), ("part = 1", CALIBRATE))
    ]
    chosen = rows.sparkSession.createDataFrame([(r.doc_id,) for some in drawn for r in some.collect()], "doc_id bigint")
    end = F.lit(-4 * SAMPLE_WORDS)
    cut = F.when(F.length("words") <= 8 * SAMPLE_WORDS, F.col("words")).otherwise(
        F.concat(F.substring("words", 1, 4 * SAMPLE_WORDS), F.substring("words", end, F.lit(4 * SAMPLE_WORDS)))
    )
    # The drawn ids are a bounded list. Combined before the shuffle, so an id that very many rows share sends one of each task.
    picked = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "part", "lang", "text_hash", cut.alias("words"))
    row = F.struct("toxic", "part", "lang", "words")
    picked = picked.groupBy("doc_id").agg(F.min_by(row, F.struct("text_hash", F.coalesce("lang", F.lit("")))).alias("row")).select("doc_id", "row.*")
    parts = ([], [])
    for r in sorted(picked.collect(), key=lambda r: (r["doc_id"], bytes(r["words"]))):
        parts[r["part"]].append((np.frombuffer(r["words"], dtype=np.int32), r["toxic"], place.get(r["lang"], -1)))
    return train(parts[0], parts[1], len(place))


def _counted(rows: DataFrame, place: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets with a row of their own, most frequent first, and the words of each language in them, in all of ``rows``."""
    def count(batches):
        documents = np.zeros(BUCKETS, dtype=np.int64)
        words: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("words"), batch.column("lang").to_pylist()):
                found = np.frombuffer(text.as_buffer(), dtype=np.int32)
                documents[np.unique(found)] += 1
                at = place.get(lang, -1)
                if at not in words:
                    words[at] = np.zeros(BUCKETS, dtype=np.int64)
                np.add.at(words[at], found, 1)
        seen = np.flatnonzero(documents)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(np.full(len(seen), -1)), pa.array(documents[seen])], names)
        for at, counts in words.items():
            if at >= 0:
                seen = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(np.full(len(seen), at)), pa.array(counts[seen])], names)

    names = ["bucket", "at", "n"]
    counts = rows.select("words", "lang").mapInArrow(count, "bucket bigint, at bigint, n bigint")
    counts = counts.groupBy("bucket", "at").agg(F.sum("n").alias("n"))
    counts = counts.groupBy("bucket").agg(
        F.sum(F.when(F.col("at") < 0, F.col("n"))).alias("documents"),
        *[F.coalesce(F.sum(F.when(F.col("at") == k, F.col("n"))), F.lit(0)).alias(f"n{k}") for k in range(len(place))],
    )
    least = min(LEAST_DOCS, max(1, rows.count() // 20))
    # A bounded table: one row per bucket with a row of its own.
    found = counts.filter(F.col("documents") >= least).orderBy(F.desc("documents"), "bucket").limit(ROWS).toArrow()
    own = found.column("bucket").to_numpy().astype(np.int64)
    return own, np.stack([found.column(f"n{k}").to_numpy() for k in range(len(place))] or [np.zeros(len(own))], axis=1)


def _widened(made: Network, own: np.ndarray, words: np.ndarray, seed: int = 7) -> Network:
    """``made`` with rows for the buckets ``own``, as it has them or fresh, and with languages told by ``words``."""
    row = np.zeros(BUCKETS, dtype=np.int32)
    row[own] = np.arange(1, len(own) + 1)
    e = np.random.default_rng(seed).normal(0, 0.1, (len(own) + 2, DIMENSIONS)).astype(np.float32)
    had = made.row[own]
    e[1:-1][had > 0] = made.words[had[had > 0]]
    e[[0, -1]] = 0
    language = np.ones((len(own) + 2, words.shape[1]))
    language[1:-1] += words
    language = np.log(language / language.sum(axis=0))
    language[[0, -1]] = 0
    return Network(row, e, made.filters, made.biases, made.out, made.bias, language.astype(np.float32), made.thresholds)


def _arrays(made: Network) -> dict[str, np.ndarray]:
    """All trained arrays but those of words."""
    p = {"o": made.out, "b": np.array([made.bias], dtype=np.float32)}
    for width, filters, biases in zip(WIDTHS, made.filters, made.biases):
        p[f"w{width}"], p[f"c{width}"] = filters, biases
    return p


def _replica(made: Network, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int, times: int):
    """What going through some documents ``times`` times adds to the weights: rows of words, how often each was met, its change; the change of all other arrays in a line."""
    r = np.random.default_rng(seed)
    texts = [made.row[t] for t in texts]
    met = np.zeros(len(made.words), dtype=np.int64)
    for t in texts:
        np.add.at(met, t, 1)
    met[0] = 0
    own = np.flatnonzero(met)
    place = np.zeros(len(met), dtype=np.int64)
    place[own] = np.arange(1, len(own) + 1)
    nothing = np.zeros((1, DIMENSIONS), dtype=np.float32)
    before = {"e": np.concatenate([nothing, made.words[own], nothing]), **_arrays(made)}
    adam = Adam(dict(before))
    lengths = np.array([len(t) for t in texts])
    for _ in range(times):
        order, i = r.permutation(len(texts)), 0
        while i < len(order):
            # Up to BATCH texts; fewer, or one alone, where they are long.
            j = i + max(1, int(np.searchsorted(np.cumsum(lengths[order[i : i + BATCH]]), STEP_WORDS, side="right")))
            some = order[i:j]
            at = np.concatenate([[0], np.cumsum(lengths[some])])
            ids = place[np.concatenate([texts[k] for k in some])]
            adam.step(_gradients(adam.p, ids, at, labels[some], weights[some], r))
            i = j
    change = {k: (adam.p[k] - before[k]).astype(np.float32) for k in before}
    return own, met[own], change["e"][1:-1], np.concatenate([change[k].ravel() for k in sorted(change) if k != "e"])


def _passed(rows: DataFrame, made: Network, weight: tuple[float, float], seed: int, times: int) -> Network:
    """``made`` after all ``rows`` were gone through: each task trains on its own from the same weights, the changes are averaged.

    A row of words is averaged over the documents that have its word, so rare words aren't held back by tasks without them.
    """
    sent = rows.sparkSession.sparkContext.broadcast(made)
    names = ["block", "task", "turn", "rows", "met", "change"]

    def replicas(batches):
        task, turn, texts, labels, held = TaskContext.get().partitionId(), 0, [], [], 0

        def trained():
            y = np.array(labels, dtype=np.float32)
            own, met, change, rest = _replica(sent.value, texts, y, np.where(y == 1, weight[1], weight[0]).astype(np.float32), seed, times)
            parts = [(-1, np.zeros(1, dtype=np.int64), np.array([len(y)]), rest)]
            at = np.searchsorted(own, np.arange(0, len(sent.value.words) + BLOCK_ROWS, BLOCK_ROWS))
            parts += [(b, own[i:j], met[i:j], change[i:j]) for b, (i, j) in enumerate(zip(at, at[1:])) if j > i]
            for block, ids, n, values in parts:
                arrays = [[block], [task], [turn], [ids.astype(np.int32).tobytes()], [n.astype(np.int64).tobytes()], [values.astype(np.float32).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, kinds)], names)

        for batch in batches:
            for words, toxic in zip(batch.column("words"), batch.column("toxic").to_pylist()):
                texts.append(np.frombuffer(words.as_py(), dtype=np.int32))
                labels.append(toxic)
                held += len(texts[-1])
                if held >= REPLICA_WORDS:
                    yield from trained()
                    turn, held = turn + 1, 0
                    texts.clear()
                    labels.clear()
        if texts:
            yield from trained()

    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def averaged(batches):
        """Rows come in the order of their block; one block's sums are held at a time."""
        def mean():
            some = np.flatnonzero(n)
            values = (sums[some] / n[some, None]).astype(np.float32)
            arrays = [[block], [0], [0], [(some + max(block, 0) * BLOCK_ROWS).astype(np.int32).tobytes()], [n[some].astype(np.int64).tobytes()], [values.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, kinds)], names)

        block, sums, n = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                ids, met = np.frombuffer(row["rows"], dtype=np.int32), np.frombuffer(row["met"], dtype=np.int64)
                values = np.frombuffer(row["change"], dtype=np.float32).reshape(len(ids), -1)
                if row["block"] != block:
                    if block is not None:
                        yield mean()
                    block = row["block"]
                    n = np.zeros(1 if block < 0 else BLOCK_ROWS, dtype=np.int64)
                    sums = np.zeros((len(n), values.shape[1]))
                at = ids - max(block, 0) * BLOCK_ROWS
                n[at] += met
                sums[at] += values * met[:, None]
        if block is not None:
            yield mean()

    schema = "block int, task int, turn int, rows binary, met binary, change binary"
    changes = rows.select("words", "toxic").mapInArrow(replicas, schema)
    changes = changes.repartition("block").sortWithinPartitions("block", "task", "turn").mapInArrow(averaged, schema)
    e, p = made.words.copy(), _arrays(made)
    # As large as the network.
    for change in changes.collect():
        values = np.frombuffer(change["change"], dtype=np.float32)
        if change["block"] >= 0:
            e[np.frombuffer(change["rows"], dtype=np.int32)] += values.reshape(-1, DIMENSIONS)
            continue
        at = 0
        for k in sorted(p):
            p[k] = (p[k] + values[at : at + p[k].size].reshape(p[k].shape)).astype(np.float32)
            at += p[k].size
    sent.unpersist()
    return Network(made.row, e, [p[f"w{w}"] for w in WIDTHS], [p[f"c{w}"] for w in WIDTHS], p["o"], float(p["b"][0]), made.language, made.thresholds)


def _cuts(rows: DataFrame, made: Network, languages: int) -> np.ndarray:
    """Thresholds by language, off the counts of all ``rows`` by language, step of the logit and label."""
    sent = rows.sparkSession.sparkContext.broadcast(made)
    names = ["language", "bin", "toxic", "n"]

    def count(batches):
        made = sent.value
        for batch in batches:
            texts, i = [np.frombuffer(w.as_buffer(), dtype=np.int32) for w in batch.column("words")], 0
            at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            logits, guessed = [np.empty(0)], [np.empty(0, dtype=np.int64)]
            while i < len(texts):
                j = min(max(i + 1, int(np.searchsorted(at, at[i] + STEP_WORDS, side="right")) - 1), len(texts))
                ids = made.row[np.concatenate(texts[i:j])].astype(np.int64)
                logits.append(made.logits(ids, at[i : j + 1] - at[i]))
                guessed.append(_languages(made, ids, at[i : j + 1] - at[i]))
                i = j
            bins = np.round(np.clip(np.concatenate(logits), -LARGEST_LOGIT, LARGEST_LOGIT) / LOGIT_STEP).astype(np.int64)
            found, n = np.unique(np.stack([np.concatenate(guessed), bins, batch.column("toxic").to_numpy().astype(np.int64)]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([*map(pa.array, found), pa.array(n)], names)

    counts = rows.select("words", "toxic").mapInArrow(count, "language bigint, bin bigint, toxic bigint, n bigint")
    found = counts.groupBy("language", "bin").agg(F.sum(F.col("toxic") * F.col("n")).alias("toxic"), F.sum("n").alias("n")).toArrow()
    language, bins, toxic, n = (found.column(c).to_numpy() for c in ("language", "bin", "toxic", "n"))
    every = np.unique(bins)
    of = np.searchsorted(every, bins)
    by_bin = np.bincount(of, toxic), np.bincount(of, n)
    cuts = np.full(max(1, languages), _bincut(every, *by_bin) if toxic.any() else float(bins.max() * LOGIT_STEP) + 1)
    for k in range(languages):
        mine = language == k
        if LEAST_TOXIC <= toxic[mine].sum() < n[mine].sum():
            cuts[k] = _bincut(bins[mine], toxic[mine], n[mine])
    sent.unpersist()
    return cuts


def fit(documents: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> Network | None:
    """Fit on all labelled documents whose crc32 of the id as text doesn't leave ``fold`` modulo ``folds``.

    Two thirds of them, by a hash of the id, train the weights and all others set the thresholds. Their words are hashed
    once, whole texts, to a written table that all steps read. ``_start`` gives the first weights; words, languages, weights and
    thresholds then come from all rows. What reaches the driver is as large as the network, however many documents there are.
    A document with several labels is toxic if one says so; rows with a null id or null label don't count; rows that
    share a labelled id are documents of their own. A document's language column serves to learn what its words look like.
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id"), folds, fold))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    turn = F.xxhash64("doc_id", F.lit("toxicity"))
    known = known.withColumn("part", (F.pmod(turn, F.lit(3)) == 0).cast("int"))
    scratch = Scratch(documents.sparkSession, "toxicity")
    rows = scratch.keep(_features(documents, known), "words")
    counts = {(r["part"], r["toxic"]): r["count"] for r in rows.groupBy("part", "toxic").count().collect()}
    by_language = rows.filter("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    place = {lang: k for k, lang in enumerate(sorted(r["lang"] for r in by_language))}
    made = _start(rows, turn, place)
    if made is None:
        return None
    made = _widened(made, *_counted(rows, place))
    training = rows.filter("part = 0")
    n = sum(n for (part, _), n in counts.items() if part == 0)
    share = counts[0, 1] / n
    for seed in range(PASSES):
        # Few documents are gone through more often, as in the start.
        made = _passed(training, made, (0.5 / (1 - share), 0.5 / share), seed, max(1, LEAST_STEPS * BATCH // (PASSES * n)))
    made.thresholds = _cuts(rows.filter("part = 1") if any(part == 1 for part, _ in counts) else training, made, len(place))
    scratch.drop(rows)
    return made


def score(documents: DataFrame, made: Network | None, folds: int = 5, fold: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text of ``documents (doc_id, text)``.

    A null or empty text is scored as one without words. Without a network (no labels of both classes
    to learn from) every score is 0. Repeated rows keep their rows; other columns aren't read.
    """
    sent = documents.sparkSession.sparkContext.broadcast(made)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores(sent.value, batch.column("text")))], ["doc_id", "held_out", "score"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id"), folds, fold).alias("held_out"), "text")
    scored = rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
