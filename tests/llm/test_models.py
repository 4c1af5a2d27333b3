"""Near vectors, language identification and toxicity."""

import math
import zlib

import numpy as np
import pytest

from sheetstar.llm import language, near_vectors, toxicity

SF = "/root/testdata/sf0.01"


def brute_links(rows, threshold):
    """{row number: (links, component)} by comparing all pairs of a label."""
    usable = [v is not None and label is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    unit = [np.array(v, dtype=float) / math.sqrt(sum(float(x) * x for x in v)) if ok else None for ok, (_, v, _) in zip(usable, rows)]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    names = {}
    for i, (ident, _, _) in enumerate(rows):
        names[root(i)] = min(names.get(root(i), ident), ident)
    return sorted((ident, links[i], names[root(i)]) for i, (ident, _, _) in enumerate(rows))


def vectors(seed, n, dimensions=16):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = r.standard_normal(dimensions)
        for _ in range(r.integers(1, 5)):
            rows.append((len(rows), [float(x) for x in np.float32(base + r.standard_normal(dimensions) * r.choice([0.02, 0.1, 0.2]))], int(i % 3)))
    return rows


@pytest.mark.parametrize("chunk", [1_500, 3])
def test_near_vectors_as_by_comparing_all(spark, chunk):
    rows = vectors(4, 120)
    rows += [(1_000 + i, rows[0][1], 0) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors.near_duplicates(df, chunk=chunk).collect())
    want = brute_links(rows, near_vectors.THRESHOLD)
    assert got == want


def test_near_vectors_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [1.0, inf], 1), (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1),
            (9, [2.0, 4.0], 1), (9, [2.0, 4.0], 1), (10, [1.0, 2.0, 0.0], 1), (11, [1.0, 2.0], 2)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, id string, copies int")
    got = sorted(tuple(r)[:4] for r in near_vectors.near_duplicates(df).collect())
    linked = {8: (2, 8, True), 9: (2, 8, False)}
    assert got == sorted((i, *linked.get(i, (0, i, True))) for i, _, _ in rows)
    assert near_vectors.near_duplicates(df.limit(0)).collect() == []


def test_window_gives_the_recall():
    w = near_vectors.window(0.9, 12, 3, 0.99)
    r = np.random.default_rng(0)
    misses = (np.abs(r.standard_normal((100_000, 12)) * math.sqrt(0.2)) > w).sum(axis=1)
    assert abs((misses < 3).mean() - 0.99) < 0.003


# -- language --------------------------------------------------------------------------------


def test_held_out_accuracy_and_columns(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in documents.collect()}
    rows = language.identify(documents).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.97 * len(out)


def test_backs_off_to_the_longest_known_grams():
    model = language.Model(["a", "b"], {"known": 0}, {(3, "xyz"): 1, (1, "q"): 2}, np.log([[0.9, 0.1], [0.2, 0.8], [0.6, 0.4]]), np.zeros(2))
    scorer = language.Scorer(model)
    assert scorer.score("Known")[0] == "a" and scorer.score("wxyzq")[0] == "b" and scorer.score("q")[0] == "a"
    assert scorer.score("?? 12") == ("und", 0.0) and scorer.score(None) == ("und", 0.0) and scorer.score("²") == ("und", 0.0)
    assert scorer.score("zz")[1] == 0.5


def test_remembering_changes_nothing(monkeypatch):
    model = language.Model(["a", "b"], {"known": 0}, {(1, c): i for i, c in enumerate("xyz")}, np.log([[0.9, 0.1], [0.2, 0.8], [0.6, 0.4]]), np.zeros(2))
    text = "known x xx xyz zzz known yy"
    before = language.Scorer(model).score(text)
    monkeypatch.setattr(language, "REMEMBERED", 1)
    after = language.Scorer(model).score(text)
    assert before[0] == after[0] and before[1] == pytest.approx(after[1])


def test_language_edge_cases(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(8)] + [(20 + i, "le chat et le chien", "fr") for i in range(8)]
    rows += [(50, None, "en"), (51, "", None), (52, "123 !!", "fr"), (None, "the dog", "en"), (53, "le chien " * 50_000, None), (1, "the cat and the dog", "en")]
    df = spark.createDataFrame([(*r, "s", 3) for r in rows], "doc_id bigint, text string, lang string, source string, score int")
    got = {r.doc_id: (r.lang_pred, r.held_out) for r in language.identify(df).collect()}
    assert [got[k][0] for k in (50, 51, 52, None, 53, 1)] == ["und", "und", "und", "en", "fr", "en"]
    assert got[None][1] is False
    kept = language.accepted(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3
    assert language.identify(df.limit(0)).collect() == []
    assert {r.lang_pred for r in language.identify(df.withColumn("lang", df["lang"].substr(9, 1)).filter("false")).collect()} == set()


# -- toxicity --------------------------------------------------------------------------------


def sample(n, seed):
    r = np.random.default_rng(seed)
    clean, toxic = [f"w{i}" for i in range(300)], ["vile", "nasty", "rotten"]
    rows = []
    for i in range(n):
        words = list(r.choice(clean, r.integers(0, 60)))
        bad = i % 3 == 0
        if bad:
            words.insert(r.integers(0, len(words) + 1), str(r.choice(toxic)))
        rows.append((i, " ".join(words), "en" if i % 2 else "de", int(bad)))
    return rows


def test_toxic_words_are_found_on_held_out_rows(spark):
    rows = sample(1_500, 3)
    documents = spark.createDataFrame([(*r[:3], "s", 1.0) for r in rows], "doc_id bigint, text string, lang string, source string, score double")
    labels = spark.createDataFrame([(r[0], 1, r[3]) for r in rows if r[0] % 7], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(documents, toxicity.fit(documents, labels)).collect()}
    assert len(got) == len(rows)
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[r[0]].held_out for r in out) and sum(g.held_out for g in got.values()) == len(out)
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for g in got.values())
    assert sum(got[r[0]].predicted == r[3] for r in out) >= 0.97 * len(out)


def test_toxicity_edge_cases(spark):
    rows = sample(300, 5)
    documents = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(None, 1), (3, None), (3, 1), (99_999, 1)], "doc_id bigint, toxic int")
    made = toxicity.fit(documents, labels)
    odd = spark.createDataFrame([(1, None, None), (2, "", "xx"), (None, "vile", "en"), (4, "w1 " * 300_000 + "vile", "en"), (4, "w1", "en"), (4, "w1", "en")], "doc_id bigint, text string, lang string")
    got = toxicity.score(odd, made).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert {r.predicted for r in got if r.doc_id in (1, 2)} == {0}
    assert toxicity.score(odd.limit(0), made).collect() == []
    assert toxicity.fit(documents, labels.limit(0)) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.0}


def test_pooling_sees_each_text_alone():
    rows = [(np.array(w, dtype=np.int32), y, 0) for w, y in (([1, 2, 3], 1), ([4, 5], 0), ([1, 9], 1), ([], 0), ([7, 8, 4], 0), ([2, 1], 1))] * 12
    made = toxicity.train(rows, rows, 1)
    ids = [made.row[w].astype(np.int64) for w, _, _ in rows]
    at = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
    together = made.logits(np.concatenate(ids), at)
    alone = [float(made.logits(i, np.array([0, len(i)]))[0]) for i in ids]
    assert np.allclose(together, alone, atol=1e-4)


def test_more_languages_than_any_fixed_number(spark):
    rows = [(i, " ".join(f"w{i % 200}x{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(5)), f"l{i % 200}") for i in range(1_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = language.identify(df).collect()
    assert len({r.lang_pred for r in found}) == 200
    assert sum(r.lang_pred == f"l{r.doc_id % 200}" for r in found) > 950


def test_rows_that_share_a_drawn_id_send_one(spark, monkeypatch):
    """What the fit collects is one row per drawn id, with a bounded number of words."""
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 10)
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda train, cut, n: seen.append((train, cut)))
    docs = spark.createDataFrame([(1, f"word{i} " * 500, "en") for i in range(300)] + [(2, "b c", None), (2, "b c", "en"), (3, "d", "de")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in (1, 2, 3)], "doc_id bigint, quality int, toxic int")
    for shuffled in (docs.repartition(7), docs.repartition(3)):
        toxicity.fit(shuffled, labels, folds=10**9, fold=5)
    rows = [[(w.tolist(), toxic, lang) for part in both for w, toxic, lang in part] for both in seen]
    assert rows[0] == rows[1] and len(rows[0]) == 3 and max(len(w) for w, _, _ in rows[0]) == 20


def test_all_labelled_documents_are_learned_from(spark, monkeypatch):
    """Toxic words that hardly any drawn document has are found all the same, far inside texts too."""
    for name in ("TRAIN_TOXIC", "TRAIN_CLEAN", "CALIBRATE", "SAMPLE_WORDS"):
        monkeypatch.setattr(toxicity, name, 20)
    r = np.random.default_rng(1)
    rows = []
    for i in range(3_000):
        words = [f"w{k}" for k in r.integers(0, 200, 60)]
        if i % 3 == 0:
            words[30] = f"bad{i // 3 % 40}"
        rows.append((i, " ".join(words), "en", int(i % 3 == 0)))
    documents = spark.createDataFrame([w[:3] for w in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(w[0], w[3]) for w in rows], "doc_id bigint, toxic int")
    got = {w.doc_id: w for w in toxicity.score(documents, toxicity.fit(documents, labels)).collect()}
    out = [w for w in rows if got[w[0]].held_out]
    assert sum(got[w[0]].predicted == w[3] for w in out) >= 0.95 * len(out)


def test_winning_windows_of_long_texts_are_found_in_steps(monkeypatch):
    """A text of many steps passes the gradients that it passes when worked on at once."""
    r = np.random.default_rng(2)
    p = {"e": r.normal(size=(12, toxicity.DIMENSIONS)), "o": r.normal(size=toxicity.FILTERS * 3), "b": np.zeros(1)}
    p["e"][[0, -1]] = 0
    for width in toxicity.WIDTHS:
        p[f"w{width}"], p[f"c{width}"] = r.normal(size=(width, toxicity.DIMENSIONS, toxicity.FILTERS)), r.normal(size=toxicity.FILTERS)
    ids, at, y = r.integers(0, 11, 130), np.array([0, 100, 100, 130]), np.array([1, 0, 1])
    whole = toxicity._gradients(p, ids, at, y, np.ones(3), np.random.default_rng(3))
    monkeypatch.setattr(toxicity, "STEP_WORDS", 7)
    steps = toxicity._gradients(p, ids, at, y, np.ones(3), np.random.default_rng(3))
    assert all(np.allclose(whole[k], steps[k]) for k in p)
