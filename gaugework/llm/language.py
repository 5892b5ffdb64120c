"""Language identification by words first, with character n-grams as backoff for unseen words.

Training counts every word of every learnt document by language (partial counts in the tasks, a sum by
language and word), and from those counts all character n-grams. A word or n-gram enters the model when it
makes up at least a given share of some language's words or n-grams, so that the model holds at most
languages x (1 / word_share + orders / gram_share) entries, whatever the corpus; each entry has smoothed
log frequencies for all languages. A text's score for a language is the sum over its words: the word's
own log frequency, or for unseen words the mean over its n-grams of the longest order at least half of
whose n-grams are known.

Defined results: a null text and one without a letter are ``und`` with score 0, and so is every text when
nothing was learnt; ties go to the language that comes first in the alphabet; a null id is not held out;
repeated rows count as often as they come; other columns are ignored by ``predict`` and carried by ``keep``.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import query, stored, table
from .memory import only

#: Characters that regular expressions take for parts of words, but that are numbers (fractions, Roman numerals, circled digits).
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
WORD = re.compile(rf"[^\W\d_{_NUMBERS}]+")
#: The same but for those numbers; twenty times as fast, as the class has no long list.
_RUN = re.compile(r"[^\W\d_]+")
ORDERS = (4, 3, 2, 1)
WORD_SHARE, GRAM_SHARE = 1e-5, 1e-4
#: Words that count as independent evidence in the reported score.
EVIDENCE = 10
MIN_SCORE = 0.5
#: Words that a task counts before it passes them on, rows that it passes on at once, and words that a worker remembers.
_HELD, _PASSED, _REMEMBERED = 150_000, 10_000, 500_000


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters, in order."""
    runs = _RUN.findall(text.lower())
    if "".join(runs).isalpha():
        return runs
    return [word for run in runs for word in ([run] if run.isalpha() else WORD.findall(run))]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over all rows of ``docs`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("language")
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                held.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
                if sum(map(len, held.values())) > _HELD:
                    yield from flush(held)
        yield from flush(held)

    def flush(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            left = iter(words.items())
            while some := list(islice(left, _PASSED)):
                columns = [pa.array([lang] * len(some), pa.string()), pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])
        held.clear()

    counted = docs.select("lang", "text").where("lang is not null and text is not null").mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Log frequencies by language: of words, and of n-grams of each order. Bounded in size; sent to all tasks."""

    def __init__(self, langs: list[str], tables: dict[int, dict[str, np.ndarray]]):
        self.langs, self.tables = langs, tables
        self.orders = sorted((k for k in tables if k), reverse=True)

    def unseen(self, word: str) -> np.ndarray:
        framed = f"<{word}>"
        for k in self.orders:
            known = self.tables[k]
            grams = [framed[i : i + k] for i in range(len(framed) - k + 1)] if k > 1 else list(word)
            found = [known[g] for g in grams if g in known]
            if found and 2 * len(found) >= len(grams):
                return np.mean(found, axis=0)
        return np.zeros(len(self.langs))


def learn(docs: DataFrame, word_share: float = WORD_SHARE, gram_share: float = GRAM_SHARE, orders: Iterable[int] = ORDERS) -> Model:
    """Model of all rows of ``docs`` with text and lang."""
    words = stored(_word_counts(docs), "word-counts")
    units = words.select(F.lit(0).alias("k"), "lang", F.col("word").alias("unit"), "n")
    for k in orders:
        framed = words.select("lang", (F.concat(F.lit("<"), "word", F.lit(">")) if k > 1 else F.col("word")).alias("framed"), "n")
        grams = F.expr(f"explode(transform(sequence(1, length(framed) - {k} + 1), i -> substring(framed, i, {k})))")
        some = framed.where(F.length("framed") >= k).select(F.lit(k).alias("k"), "lang", grams.alias("unit"), "n")
        units = units.unionByName(some.groupBy("k", "lang", "unit").agg(F.sum("n").alias("n")))
    units = stored(units, "language-units")
    sizes = {(r["k"], r["lang"]): (r["total"], r["kinds"]) for r in units.groupBy("k", "lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).collect()}
    langs = sorted({lang for _, lang in sizes})
    if not langs:
        return Model([], {})
    share = units.sparkSession.createDataFrame(
        [(k, lang, max(2.0 if not k else 1.0, total * (gram_share if k else word_share))) for (k, lang), (total, _) in sizes.items()], "k int, lang string, least double"
    )
    common = units.join(F.broadcast(share), ["k", "lang"]).where("n >= least").select("k", "unit").distinct()  # one row a language and order
    rows = units.join(common, ["k", "unit"]).groupBy("k", "unit").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n"))
    counts = rows.select("k", "unit", F.array(*[F.coalesce(F.col("n")[x], F.lit(0)) for x in langs]).alias("n")).toArrow()
    tables: dict[int, dict[str, np.ndarray]] = {k: {} for k, _ in sizes}
    totals = {k: np.array([sizes.get((k, x), (0, 0)) for x in langs], dtype=np.float64) for k in tables}
    matrix = np.array(counts["n"].to_pylist(), dtype=np.float64).reshape(-1, len(langs))
    for k, unit, n in zip(counts["k"].to_pylist(), counts["unit"].to_pylist(), matrix, strict=True):
        total, kinds = totals[k].T
        tables[k][unit] = np.log((n + 0.5) / (total + 0.5 * kinds + 1)).astype(np.float32)
    return Model(langs, tables)


class _Rows(dict):
    """Word -> row of its log frequencies; words are looked up in the model when they first come."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.values = np.zeros((1024, max(1, len(model.langs))), dtype=np.float32)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        known = self.model.tables[0].get(word)
        self.values[at] = self.model.unseen(word) if known is None else known
        self[word] = at
        return at


class Scorer:
    """Labels texts by a model; forgets the words it has seen when they are more than ``most``."""

    def __init__(self, model: Model, most: int = _REMEMBERED):
        self.model, self.most, self.rows = model, most, _Rows(model)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if not words or not self.model.langs:
            return "und", 0.0
        if len(self.rows) > self.most:
            self.rows = _Rows(self.model)
        at = np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))
        mean = self.rows.values[at].mean(axis=0, dtype=np.float64)
        best = int(np.argmax(mean))  # the first of equals; languages are in alphabetical order
        odds = np.exp((mean - mean[best]) * min(len(words), EVIDENCE))
        return self.model.langs[best], float(1 / odds.sum())


_SCORERS: dict[int, Scorer] = {}


def _scorer(shared) -> Scorer:
    """One scorer per Python worker and broadcast model."""
    if shared.value is not getattr(_SCORERS.get(0), "model", None):
        _SCORERS[0] = Scorer(shared.value)
    return _SCORERS[0]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(shared)
        for batch in batches:
            found = [score(text.as_py()) for text in batch.column(2)]
            labels, scores = pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), labels, scores], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is told with at least ``min_score``; a null lang is filled in.

    Only the texts go through Python.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def told(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = _scorer(shared)
        for batch in texts:
            found = [score(text.as_py()) for text in batch]
            columns = [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.StructArray.from_arrays(columns, names=["lang", "score"])

    # else the filter would be moved below the projection and the texts be told twice
    rows = docs.select(F.struct(*docs.columns).alias("row"), told.asNondeterministic()("text").alias("told")).where(F.col("told.score") >= min_score)
    kind = docs.schema["lang"].dataType
    filled = F.coalesce("row.lang", F.col("told.lang").cast(kind)).alias("lang")
    return rows.select(*[filled if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def learnt_from(docs: DataFrame) -> DataFrame:
    """What a model may see of ``docs``: text and lang of the documents that aren't held out."""
    return docs.where(~held_out()).select("lang", "text")


@query("op4_word_backoff_language")
def op4_word_backoff_language(spark, folder):
    """Language of every document, from a model of those not held out."""
    docs = table(spark, folder, "documents")
    return predict(docs.select("doc_id", "text"), learn(learnt_from(docs)))
