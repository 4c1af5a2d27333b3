"""The pipeline, stage by stage, against plain Python on the documents each stage is given."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sheetstar.llm import pipeline as corpus_pipeline
from sheetstar.llm import language, mixing, token_files
from sheetstar.llm.common import Scratch
from tests.llm.test_contamination import brute as contaminated
from tests.llm.test_set_join import brute as grouped
from tests.llm.test_token_files import direct

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage keeps, the given documents first."""
    scratch = Scratch(spark, "test")
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(scratch.keep(stage(spark, frames[-1], SF), "stage"))
    return frames


def test_all_but_the_last_return_documents(kept):
    assert all(f.columns == kept[0].columns for f in kept[:-1])
    assert all(f.count() > 0 for f in kept)


def test_language_rejects_only_what_cannot_be_told(spark, kept):
    model = language.fit(kept[0].filter("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    scorer = language.Scorer(model)
    want = [r.doc_id for r in kept[0].collect() if scorer.score(r.text)[0] != "und"]
    assert sorted(r.doc_id for r in kept[1].collect()) == sorted(want)


def test_one_of_each_group_stays(kept):
    names = grouped([(r.doc_id, r.text) for r in kept[1].collect()])
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(d for d, _, c in names if d == c)


def test_contaminated_documents_go(spark, kept):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in kept[2].collect()]
    assert sorted(r.doc_id for r in kept[3].collect()) == sorted(r[0] for r in contaminated(rows, items) if not r[5])


def test_mixture_repeats_documents(kept):
    copies = {r.doc_id: r.copies for r in mixing.mix(kept[3]).collect()}
    assert Counter(r.doc_id for r in kept[4].collect()) == Counter({d: n for d, n in copies.items() if n})
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows)
    assert words(kept[4].collect()) == pytest.approx(1.5 * words(kept[3].collect()), rel=0.05)


def test_ids_are_those_of_the_tokenizer(kept):
    rows = sorted((r.doc_id, r.text) for r in kept[4].collect())
    start, want = 0, []
    for (doc, _), ids in zip(rows, direct([t for _, t in rows])):
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4"))))
        start += len(ids)
    assert sorted(map(tuple, kept[5].collect())) == sorted(want)


def test_run_gives_the_last_stage(spark, kept):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, kept[5].collect()))


def test_stages_stand_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "the house and the dog", "en", "s", 1), (2, "", "en", None, 0), (2, "", "en", None, 0),
            (3, "a b c " * 40_000, "en", "s", 5), (4, "the house and the dog", None, "s", 2), (4, "the house and the dog", None, "s", 2)]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, copies string, _key int")
    scratch = Scratch(spark, "test")
    for frame in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = scratch.keep(stage(spark, frame, SF), "odd")
            assert out.columns == df.columns or out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_short_texts_that_languages_share_stay(spark):
    shared = ["a", "re", "de"]
    rows = [(i, f"{shared[i // 6 % 3]} word{i % 7}{lang}", lang) for i, lang in enumerate(["en", "fr", "de", "nl", "it", "es"] * 40)]
    rows += [(1_000, "A.", None), (1_001, "Re.", None), (1_002, "...", None), (1_003, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.identified(spark, df, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(240), 1_000, 1_001]


def test_without_labels_no_corpus_is_lost(spark):
    rows = [(i, f"some words {i}" if i % 10 else "123 ...", None, "s") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = corpus_pipeline.identified(spark, df, SF).collect()
    assert sorted(r.doc_id for r in kept) == [i for i in range(50) if i % 10]
    assert all(r.lang is None for r in kept)


def test_a_missing_language_is_filled_in(spark):
    """One label, and several: rows without a language get the predicted one, others keep theirs."""
    text = {"en": "the house and the dog", "de": "das haus und der hund"}
    rows = [(i, text["de" if i % 2 else "en"], None if i % 5 == 0 else "de" if i % 2 else "en") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {(r.doc_id, r.lang) for r in corpus_pipeline.identified(spark, df, SF).collect()} == {(i, "de" if i % 2 else "en") for i in range(200)}
    one = df.filter("lang is null or lang = 'en'")
    assert {r.lang for r in corpus_pipeline.identified(spark, one, SF).collect()} == {"en"}
