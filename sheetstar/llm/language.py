"""Language identification: word frequencies first, shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetstar.llm.common import held_out, release_memory, small_batches

UNDETERMINED = "und"
#: Bounds of the fit: labelled documents per language, words, n-grams of each length. All labelled languages are learned.
DOCUMENTS_PER_LANGUAGE = 4_000
WORDS = 40_000
GRAMS = 20_000
#: Lengths of n-grams, longest first; a word is marked at both ends.
LENGTHS = (5, 4, 3, 2, 1)
#: Scores of unseen words that a task remembers, at most so many words and so many numbers.
REMEMBERED = 200_000
REMEMBERED_NUMBERS = 3_200_000
SMOOTHING = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased; none if the text has no letter."""
    words = _WORD.findall(text.lower())
    if words and not words[0].isalpha() and not any(map(str.isalpha, text)):
        return []
    return words


def grams_of(word: str, length: int) -> list[str]:
    marked = f"<{word}>" if length > 1 else word
    return [marked[i : i + length] for i in range(len(marked) - length + 1)]


@dataclass
class Model:
    """Per language log frequencies: ``rows`` gives a word's or (length, n-gram)'s line of ``scores``."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[tuple[int, str], int]
    scores: np.ndarray
    unknown: np.ndarray


class Scorer:
    """Scores texts by a model and remembers a bounded number of unseen words."""

    def __init__(self, model: Model):
        self.model = model
        self.known = dict(model.words)
        remembered = min(REMEMBERED, REMEMBERED_NUMBERS // max(1, len(model.languages)))
        self.lines = np.zeros((len(model.scores) + remembered, len(model.languages)))
        self.lines[: len(model.scores)] = model.scores
        self.used = len(model.scores)

    def _backed_off(self, word: str) -> np.ndarray:
        """Mean log frequency of the word's longest known n-grams."""
        grams = self.model.grams
        for length in LENGTHS:
            found = [grams[length, g] for g in grams_of(word, length) if (length, g) in grams]
            if found:
                return self.model.scores[found].mean(axis=0)
        return self.model.unknown

    def score(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0
        known = self.known
        extra = np.zeros(len(self.model.languages))
        try:
            rows = [known[w] for w in words]
        except KeyError:
            rows, passing = [], {}
            for w in words:
                row = known.get(w)
                if row is None:
                    if self.used < len(self.lines):
                        self.lines[self.used] = self._backed_off(w)
                        row = known[w] = self.used
                        self.used += 1
                    else:
                        if w not in passing:
                            passing[w] = self._backed_off(w)
                        extra += passing[w]
                        continue
                rows.append(row)
        total = self.lines[rows].sum(axis=0) + extra
        # Words of a text depend on each other, so evidence grows with the root of their number.
        odds = np.exp((total - total.max()) / np.sqrt(len(words)))
        best = int(np.argmax(total))
        return self.model.languages[best], float(odds[best] / odds.sum())


def _counts(batches):
    """Counts of (language, length, gram) of a task's texts; length 0 stands for words."""
    words: Counter = Counter()

    def flush():
        counts: Counter = Counter()
        for (lang, word), n in words.items():
            counts[lang, 0, word] += n
            for length in LENGTHS:
                for gram in grams_of(word, length):
                    counts[lang, length, gram] += n
        items = list(counts.items())
        for i in range(0, len(items), 50_000):
            part = items[i : i + 50_000]
            yield pa.RecordBatch.from_pydict({"lang": [k[0] for k, _ in part], "length": pa.array([k[1] for k, _ in part], pa.int32()), "gram": [k[2] for k, _ in part], "n": [n for _, n in part]})

    for batch in batches:
        release_memory()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for word in words_of(text.as_py() or ""):
                words[lang, word] += 1
        if len(words) > 200_000:
            yield from flush()
            words.clear()
    yield from flush()


def fit(labelled: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE) -> Model:
    """Fit on ``labelled (doc_id, text, lang)``: up to about ``per_language`` documents of each language, by hash of the id.

    Rows with null lang or text don't count. What is collected is bounded by the parameters above times the number of
    languages. The draw is by id: rows that share one are drawn together or not at all.
    """
    small_batches(labelled.sparkSession)
    labelled = labelled.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = labelled.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], {}, {}, np.zeros((0, 0)), np.zeros(0))
    every = F.lit(1 << 30)
    limit = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(1 << 30, int((1 << 30) * per_language / r["count"])))) for r in sizes])
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("language")), every) < limit)
    counts = sample.select("lang", "text").mapInArrow(_counts, "lang string, length int, gram string, n bigint")
    counts = counts.groupBy("length", "gram", "lang").agg(F.sum("n").alias("n")).groupBy("length", "gram").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    )
    place = {lang: i for i, lang in enumerate(languages)}
    words, grams, lines, unknown = {}, {}, [], np.zeros(len(languages))
    counts = counts.filter("total > 1").persist()
    for length in (0, *LENGTHS):
        top = counts.filter(F.col("length") == length).orderBy(F.desc("total"), "gram").limit(GRAMS if length else WORDS).collect()
        table = np.zeros((len(top), len(languages)))
        for i, r in enumerate(top):
            for lang, n in r["by"].items():
                table[i, place[lang]] = n
        smooth = np.log(table + SMOOTHING) - np.log(table.sum(axis=0) + SMOOTHING * (len(top) + 1))
        at = len(lines)
        for i, r in enumerate(top):
            (words.__setitem__(r["gram"], at + i) if length == 0 else grams.__setitem__((length, r["gram"]), at + i))
        lines.extend(smooth)
    counts.unpersist()
    return Model(languages, words, grams, np.array(lines).reshape(-1, len(languages)), unknown)


_PREDICTED = "lang_pred string, score double"


def predict(documents: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``documents`` with ``lang_pred`` and ``score`` (0 to 1) of every whole text.

    ``und`` and 0 for a null text and one without letters. No row moves.
    """
    spark = documents.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    kept = documents.select(*columns, F.col("text").alias("_text"))

    def run(batches):
        scorer = Scorer(sent.value)
        for batch in batches:
            release_memory()
            found = [scorer.score(text.as_py()) for text in batch.column(batch.num_columns - 1)]
            out = batch.columns[:-1] + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(out, [*columns, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{fields}, {_PREDICTED}" if columns else _PREDICTED)


def identify(documents: DataFrame, folds: int = 4, fold: int = 2, per_language: int = DOCUMENTS_PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``documents (doc_id, text, lang)``.

    Rows whose crc32 of the id as text leaves ``fold`` modulo ``folds`` are held out of the fit; so is
    nothing with a null id. With no labelled row all are ``und``. Repeated rows keep their rows; other
    columns aren't read; an empty table gives no rows.
    """
    out = held_out(F.col("doc_id"), folds, fold)
    model = fit(documents.filter(~out), per_language)
    return predict(documents.select("doc_id", "text", out.alias("held_out")), model, ["doc_id", "held_out"])


def accepted(documents: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """``documents`` without those that get no language, a null ``lang`` replaced by the predicted one; all columns kept.

    Only texts without any letter get none: a score falls with the number of languages and for short texts, however
    clean, so no least score is asked for. Where no row is labelled nothing can be predicted: texts with a letter
    stay, with their null ``lang``.
    """
    model = fit(documents.filter(~held_out(F.col("doc_id"), folds, fold)))
    sent, schema = documents.sparkSession.sparkContext.broadcast(model), documents.schema
    text_at, lang_at = documents.columns.index("text"), documents.columns.index("lang")

    def run(batches):
        scorer = Scorer(sent.value)
        learned = bool(sent.value.languages)
        for batch in batches:
            release_memory()
            langs, keep = batch.column(lang_at).to_pylist(), []
            for i, text in enumerate(batch.column(text_at)):
                told, _ = scorer.score(text.as_py()) if learned else (UNDETERMINED, 0.0)
                keep.append(told != UNDETERMINED if learned else bool(words_of(text.as_py() or "")))
                if langs[i] is None and told != UNDETERMINED:
                    langs[i] = told
            batch = batch.set_column(lang_at, batch.schema.field(lang_at), pa.array(langs, batch.schema.field(lang_at).type))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, schema)
