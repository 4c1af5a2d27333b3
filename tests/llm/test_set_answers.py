import random

import numpy as np
import pytest

from sheetstar.llm import set_answers
from tests.llm.test_set_join import shingles, varied


def brute(rows):
    """[(doc_id, n, number of other rows that it links with)] by comparing every pair of rows."""
    sets = [(d, shingles(t)) for d, t in rows]
    links = dict.fromkeys(range(len(sets)), 0)
    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            if x and y and 4 * len(x & y) >= 3 * len(x | y):
                links[i] += 1
                links[j] += 1
    return sorted((d, len(s), links[i]) for i, (d, s) in enumerate(sets))


def got(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn
    return sorted(map(tuple, set_answers.link_counts(frame("n_links", set_answers.F.lit("mine")), **options).collect()))


@pytest.mark.parametrize("seed, changes, block", [(1, 2, 64), (2, 5, 2)])
def test_all_links_as_by_comparing_all(spark, seed, changes, block):
    rows = varied(seed, 60, changes)
    assert got(spark, rows, group_shingles=3_000, block=block) == brute(rows)


def test_a_large_group_of_near_copies_and_odd_rows(spark):
    r = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(w if r.random() > 0.012 else f"x{i}" for w in base)) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \t"), (503, "short text"), (504, "Short TEXT"), (505, "short"), (500, rows[0][1])]
    found = got(spark, rows, block=16)
    assert found == brute(rows)
    assert max(n for *_, n in found) > 20


def test_each_link_comes_once(spark):
    rows = varied(3, 30, 4)
    _, _, links = set_answers.all_links(spark.createDataFrame(rows, "doc_id bigint, text string"), block=3)
    pairs = [(r.a, r.b) for r in links.collect()]
    assert pairs and len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)


def test_nothing(spark):
    assert set_answers.link_counts(spark.createDataFrame([], "doc_id bigint, text string")).isEmpty()


@pytest.mark.parametrize("columns", [1, 7, 65_536])
def test_overlaps_follow_from_differences(monkeypatch, columns):
    monkeypatch.setattr(set_answers, "COLUMNS", columns)
    r = random.Random(columns)
    leaders = [set(r.sample(range(-60, 60), 50)) for _ in range(2)]
    made = []
    for leader in leaders:
        members = [(leader - set(r.sample(sorted(leader), 4))) | set(r.sample(range(-60, 60), 5)) for _ in range(6)]
        made.append([({"id": i, "n": len(m), "copies": 1, "minus": sorted(leader - m), "plus": sorted(m - leader)}, m) for i, m in enumerate(members)])
    found = set_answers._derived(len(leaders[0] & leaders[1]), *map(sorted, leaders), *[[d for d, _ in side] for side in made])
    assert np.array_equal(found, [[len(x & y) for _, y in made[1]] for _, x in made[0]])


def test_given_documents_whole(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, set_answers.link_counts(documents).collect())) == brute(rows)
