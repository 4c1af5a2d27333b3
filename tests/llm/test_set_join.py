import random
import re
from collections import defaultdict

import pytest

from sheetstar.llm import set_join

SF = "/root/testdata/sf0.01"


def shingles(text, width=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, at_least=75, of=100):
    """[(doc_id, n, component)] by comparing every pair that shares a shingle."""
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for token in s:
            where[token].append(i)
    both = defaultdict(int)
    for held in where.values():
        for a in range(len(held)):
            for b in range(a):
                both[held[b], held[a]] += 1
    for (i, j), n in both.items():
        if of * n >= at_least * (len(sets[i][1]) + len(sets[j][1]) - n):
            a, b = sorted((root(sets[i][0]), root(sets[j][0])))
            up[b] = a
    return sorted((d, len(s), root(d)) for d, s in sets)


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted(map(tuple, set_join.groups(df, **options).collect()))


def varied(seed, texts, changes):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, ident = [], 0
    passage = [r.choice(vocabulary) for _ in range(60)]
    for _ in range(texts):
        words = [r.choice(vocabulary) for _ in range(r.randint(3, 120))]
        if r.random() < 0.3:
            words = passage + words[:20]
        for _ in range(r.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(r.randint(0, changes)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append((ident, " ".join(copy)))
            ident += 1
    return rows


@pytest.mark.parametrize("seed, changes", [(1, 1), (2, 3), (3, 6)])
def test_same_components_as_comparing_all(spark, seed, changes):
    rows = varied(seed, 60, changes)
    assert got(spark, rows, group_shingles=3_000) == brute(rows)


def test_given_documents_whole(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, set_join.groups(documents).collect())) == brute(rows)


def test_many_near_copies_form_one_component(spark):
    base = [f"v{i}" for i in range(200)]
    rows = [(i, " ".join(base[: i % 190] + [f"x{i}"] + base[i % 190 + 1 :])) for i in range(150)]
    result = got(spark, rows)
    assert {c for _, _, c in result} == {0}


def test_edge_cases(spark):
    long = " ".join(f"z{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo"), (6, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"),
            (9, long), (8, long + " end"), (None, "a b c d e"), (None, "only here")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, key string, component string")
    result = sorted(map(tuple, set_join.groups(df).collect()), key=repr)
    expected = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6), (7, 1, 6), (9, 29_996, 8), (8, 29_997, 8),
                (None, 1, 6), (None, 1, None)]
    assert result == sorted(expected, key=repr)
    assert set_join.groups(df.limit(0)).collect() == []


def test_one_of_each_keeps_all_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "p"), (2, "a b c d e f", "q"), (3, None, "r")], "doc_id bigint, text string, key string")
    assert sorted(map(tuple, set_join.one_of_each(df).collect())) == [(1, "a b c d e f", "p"), (3, None, "r")]


def test_one_of_each_drops_only_near_copies(spark):
    text = lambda name, n=20: " ".join(f"{name}{i}" for i in range(n))
    rows = [(None, text("alone")), (None, text("twin")), (None, text("twin")), (5, text("twin")), (7, text("a")), (7, text("b")), (7, text("b")),
            (8, text("a") + " end"), (3, text("b") + " end"), (None, text("n")), (None, text("n")), (9, ""), (None, None), (None, " ")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, _id string")
    kept = set_join.one_of_each(df)
    assert kept.columns == df.columns
    want = [(None, text("alone")), (5, text("twin")), (7, text("a")), (3, text("b") + " end"), (None, text("n")), (9, ""), (None, None), (None, " ")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_sets_under_one_id_keep_their_own_components(spark):
    text = lambda name, n=20: " ".join(f"{name}{i}" for i in range(n))
    assert got(spark, [(7, text("a")), (7, text("b")), (3, text("a") + " end")]) == [(3, 17, 3), (7, 16, 3), (7, 16, 7)]


def test_null_ids_link(spark):
    text = lambda *changed: " ".join(f"x{i}" if i in changed else f"w{i}" for i in range(104))
    # Each differs in one place from the one in the middle, and in two places that break 10 of 100 shingles each from the other.
    rows = [(4, text(20, 60)), (None, text(20)), (2, text(20, 40)), (None, "p q r s t u v"), (None, "p q r s t u v")]
    options = {"at_least": 90, "of": 100}
    assert got(spark, rows[:1] + rows[2:3], **options) == [(2, 100, 2), (4, 100, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(map(tuple, set_join.groups(df, **options).collect()), key=repr)
    assert found == sorted([(4, 100, 2), (None, 100, 2), (2, 100, 2), (None, 3, None), (None, 3, None)], key=repr)
    assert sorted(((r.doc_id, r.text) for r in set_join.one_of_each(df, **options).collect()), key=repr) == sorted([rows[2], rows[3]], key=repr)
