import hashlib
import re

import pytest

from sheetstar.llm import contamination

SF = "/root/testdata/sf0.001"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(documents, items, width=13, share=20):
    out = []
    for doc, text in documents:
        own, hit, found = words(text), set(), set()
        for item, item_text in items:
            w = words(item_text)
            for i in range(max(1, len(w) - width + 1)) if w else ():
                window = w[i : i + width]
                for j in range(len(own) - len(window) + 1):
                    if own[j : j + len(window)] == window:
                        hit |= set(range(j, j + len(window)))
                        found.add(str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(found), sha, bool(hit) and share * len(hit) >= len(own)))
    return sorted(out, key=repr)


ITEMS = [(1, "alpha beta gamma"), (2, " ".join(f"w{i}" for i in range(20))), (3, None), (4, "...,"), (None, "never used"), (10, "beta gamma"), (1, "alpha beta gamma"), (5, "Één ZWEI drei")]
DOCUMENTS = [
    (1, "x Alpha, BETA-gamma y"), (2, " ".join(f"w{i}" for i in range(3, 18))), (3, None), (4, ""), (5, "w1 w2 w3"), (6, "Één zwei DREI"),
    (6, "één zwei drei"), (7, "pad " * 200 + "beta gamma"), (8, ("long text " * 50_000) + "alpha beta gamma"), (None, "beta gamma"), (9, "alpha beta gamma beta gamma"), (9, "alpha beta gamma beta gamma"),
]


@pytest.mark.parametrize("block_chars", [8_000_000, 40])
def test_against_brute_force(spark, block_chars):
    docs = spark.createDataFrame([(*d, "e", 1) for d in DOCUMENTS], "doc_id bigint, text string, items string, row int")
    bench = spark.createDataFrame([(*i, "z") for i in ITEMS], "item_id bigint, text string, words string")
    got = sorted(map(tuple, contamination.digest(contamination.scan(docs, bench, block_chars=block_chars)).collect()), key=repr)
    assert got == brute(DOCUMENTS, [i for i in ITEMS if i[0] is not None])
    kept = contamination.clean(docs, bench, block_chars=block_chars)
    assert kept.columns == docs.columns
    clean = sorted((d for d, t in DOCUMENTS if not brute([(d, t)], [i for i in ITEMS if i[0] is not None])[0][5]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == clean


def test_spans_are_offsets_of_the_original(spark):
    text = "— ÄÖ x Alpha, BETA-gamma y"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    (row,) = contamination.scan(docs, bench).collect()
    assert [text[s.start : s.end] for s in row.spans] == ["Alpha, BETA-gamma"]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCUMENTS, "doc_id bigint, text string")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert contamination.scan(docs.limit(0), bench).collect() == []
    assert contamination.clean(docs, bench.limit(0)).count() == len(DOCUMENTS)
    assert {r.contaminated for r in contamination.scan(docs, bench.limit(0)).collect()} == {False}


def test_one_block_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame(DOCUMENTS, "doc_id bigint, text string")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    seen, kind = [], type(docs)
    collect, scanned, keep = kind.collect, contamination._scan, contamination.Scratch.keep
    monkeypatch.setattr(kind, "collect", lambda self: seen.append("collect") or collect(self))
    monkeypatch.setattr(contamination, "_scan", lambda *a: seen.append("scan") or scanned(*a))
    monkeypatch.setattr(contamination.Scratch, "keep", lambda *a: (keep(*a), seen.append("write"))[0])
    contamination.scan(docs, bench, block_chars=40)
    events = [e for e in seen[seen.index("scan") - 1 :]]
    assert len(events) > 6 and events == ["collect", "scan", "write"] * (len(events) // 3)


def test_repeated_items_are_one(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")] * 50, "item_id bigint, text string")
    n, blocks = contamination._blocks(bench, 40)
    assert n == 1 and list(blocks) == [[("1", "alpha beta gamma")]]
