"""Runs against all shifts of short texts, and the query's numbers against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sheetstar.llm import queries, word_runs


def brute(words):
    """(start, length, period) of all runs, by start, then period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def runs(texts):
    """The operator's runs of several texts worked on together."""
    full = [t for t in texts if len(t)]
    words = np.array([w for t in full for w in t], dtype=np.int64)
    starts = np.cumsum([0, *map(len, full)])[:-1]
    found = word_runs.runs_of(words, starts).tolist()
    return [[tuple(r[1:]) for r in found if r[0] == i] for i in range(len(full))]


@pytest.mark.parametrize("seed", range(8))
def test_random_texts_with_planted_repetitions(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            n, letters = rng.choice([1, 23, 24, 40, 120, 400]), rng.choice([1, 2, 2, 3, 50])
            words = [rng.randrange(letters) for _ in range(n)]
            for _ in range(rng.randrange(5)):
                a, p = rng.randrange(n), rng.randrange(1, max(2, n // 3))
                for i in range(a, min(n, a + rng.randrange(6 * p + 40))):
                    words[i] = words[a + (i - a) % p]
            texts.append(words)
        assert runs(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("words", [
    ([0] * 9 + [1]) * 12, ([0] * 9 + [1]) * 4 + [0] * 40, (([0] * 30 + [1]) * 4 + [2]) * 4, [0, 1] * 50 + [0] * 50,
    ([0, 1] * 8 + [1]) * 9, [0] * 24, [0] * 23, list(range(8)) * 3, list(range(9)) * 3, list(range(100)) * 3 + [5],
    [0] * 70 + [1] * 70, ([0] * 16 + [1] * 16) * 5, [x % 17 for x in range(400)] + [x % 16 for x in range(400)],
])
def test_runs_inside_runs(words):
    assert runs([words, [7], words[::-1]]) == [brute(words), [], brute(words[::-1])]


def test_fibonacci_and_thue_morse_words():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    morse = [bin(i).count("1") % 2 for i in range(1024)]
    assert runs([b, morse, b * 4]) == [brute(b), brute(morse), brute(b * 4)]


def test_shorter_runs_are_refused():
    with pytest.raises(ValueError):
        word_runs.runs_of(np.zeros(5, dtype=np.int64), np.zeros(1, dtype=np.int64), least=10)


def test_tree_counts_and_successors():
    rng = np.random.default_rng(2)
    numbers = rng.permutation(300)
    tree = word_runs.WaveletTree(numbers, 9)
    for _ in range(200):
        low, high = sorted(rng.integers(0, 301, 2))
        x = int(rng.integers(0, 400))
        inside = np.sort(numbers[low:high])
        below = tree.below(np.array([low]), np.array([high]), np.array([x]))[0]
        assert below == (inside < x).sum()
        if below < len(inside):
            assert tree.nth(np.array([low]), np.array([high]), np.array([below]))[0] == inside[below]


def expected(doc, text):
    """The query's row by its contract."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2]), default=None)
    for r in found:  # exactly
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(found), *top, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def digests(df):
    key = lambda r: (r[0] is not None, r[0] or 0, r[6], r[7])
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_whole_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    found = digests(queries.op11_word_runs(spark, "/root/testdata/sf0.001"))
    assert found == sorted(expected(*r) for r in rows)
    assert sum(r[1] > 0 for r in found) > 5


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 30_000), (4, "a " * 30_000), (5, "x y z " * 9), (6, "  b " * 40), (30, "é " * 50 + "\u0000")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, runs int, _words string")
    assert digests(word_runs.digest(word_runs.find(word_runs.planted(df)))) == sorted((expected(*r) for r in rows), key=lambda r: (True, r[0], r[6], r[7]))
    out = word_runs.find(spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.n_words, r.runs, r.collapsed) for r in out] == [(None, 2, [], "a b")] * 2
    assert word_runs.find(df.limit(0)).collect() == []


def test_collapsed_text(spark):
    text = "so it goes " + "on and " * 20 + "off"
    row = word_runs.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [tuple(r) for r in row.runs] == [(3, 40, 2)] and row.collapsed == "so it goes on and off"
