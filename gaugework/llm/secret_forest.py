"""Secret scan: candidates by form, a random forest for the removal of false positives.

Candidates are strings of 16 characters or more from the alphabet of keys (letters, digits, ``+ / _ -`` and
closing ``=``), all values of 8 characters or more assigned to a credential word or given as the password of an
address, and private key blocks. Each is described by
its length, its characters, how likely its character transitions are in the corpus's words, the share that
dictionary words cover, the document's path and the neighbouring words. The dictionary and the
transitions come from the word counts of all documents: transitions between Latin letters from all words, while
a word of 3 to 32 letters enters the dictionary with a share of 1e-5 of all words (at most 100,000 words).

The forest is trained on labelled findings: by the caller's (``labelled``: doc_id, start, label), or else by
the ones whose form decides: published key formats, hex values assigned to a credential word, and key blocks
against plain words and card numbers with a right check digit. At most ``most_labelled`` findings of either
label are taken, those whose place (document, text, start) has the smallest hashes. The features hold no format names, so that the forest
judges all other candidates by what the labelled ones have in common.

Defined results: null and empty texts have no findings; repeated rows have the same findings each; where
the labelled findings lack one of the labels, the form alone decides; null paths count as empty; an empty
table gives an empty result; other columns are ignored by ``scan`` and carried by ``redact``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import query, stored, table
from .language import words_of

TOKEN = re.compile(r"\S{16,}")
CORE = re.compile(r"[A-Za-z0-9+/_\-]{16,}={0,2}")
#: Credential words of other languages.
FOREIGN = "contraseña|mot de passe|passwort|kennwort|senha|wachtwoord|hasło|пароль|密码|密钥|パスワード|비밀번호"
KEYED = re.compile(rf"(?:{FOREIGN}|password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)s?[\"']?\s*(?:=|:=?|：)\s*[\"']?((?:(?!&\w+=)[^\s\"'<>,;]){{8,}})", re.I)
ADDRESS = re.compile(r"://[^\s:/@]*:([^\s/@]{8,})@")
BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:(?!-----BEGIN ).)+?-----END [A-Z ]{0,30}PRIVATE KEY-----", re.S)
CREDENTIAL = re.compile(rf"{FOREIGN}|passw|passphrase|pwd|secret|token|api|key|auth|credential|bearer", re.I)
SAMPLE_PATH = re.compile(r"test|example|sample|fixture|mock|demo|doc", re.I)
#: Published key formats.
FORMATS = re.compile(r"AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_\-]{35}|glpat-[A-Za-z0-9_\-]{20,}")
HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")
DICTIONARY_SHARE = 1e-5
#: Letters of a dictionary word; longer strings of letters aren't words.
LONGEST_WORD = 32
MOST_LABELLED = 20_000
TREES, DEPTH = 60, 8
#: Letters beyond a to z whose transitions count.
LATIN = "\u00df-\u024f"
THRESHOLD = 0.5
MASK = "[SECRET]"
#: Buckets of hashed neighbouring words and path endings.
BUCKETS = 8
_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def candidates_of(text: str) -> Iterator[tuple[int, int]]:
    """Spans of candidates in order of their start; none overlaps another."""
    spans = []
    if "PRIVATE KEY" in text:
        spans += [m.span() for m in BLOCK.finditer(text)]
    for token in TOKEN.finditer(text):
        for core in CORE.finditer(token[0]):
            spans.append((token.start() + core.start(), token.start() + core.end()))
    spans += [m.span(1) for m in ADDRESS.finditer(text)]
    if "=" in text or ":" in text or "：" in text:
        # a published key within a longer value is a candidate of its own
        spans += [m.span(1) for m in KEYED.finditer(text) if FORMATS.fullmatch(m[1]) or not FORMATS.search(m[1])]
    last = 0
    for start, stop in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= last:
            yield start, stop
            last = stop


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def form_label(value: str, before: str) -> float | None:
    """1 or 0 where the form of a finding decides, else None."""
    if value.startswith("-----BEGIN") or FORMATS.fullmatch(value):
        return 1.0
    if value.isdigit():
        return 0.0 if 13 <= len(value) <= 19 and luhn(value) else None
    assigned = re.search(r"([\w-]+)[\"']?\s*(?:=|:)\s*[\"']?$", before)
    if assigned and CREDENTIAL.search(assigned[1]) and HEX.fullmatch(value):
        return 1.0
    if value.isalpha() and (value.islower() or value[1:].islower() or value.isupper()):
        return 0.0
    return None


class Corpus:
    """Dictionary words, and log frequencies of the transitions between two characters."""

    def __init__(self, words: Iterable[str], pairs: dict[tuple[str, str], int]):
        self.words = {w for w in words if 2 < len(w) <= LONGEST_WORD}
        self.longest = max(map(len, self.words), default=0)
        firsts: Counter = Counter()
        for (a, _), n in pairs.items():
            firsts[a] += n
        self.log = {(a, b): math.log((n + 0.5) / (firsts[a] + 18)) for (a, b), n in pairs.items()}
        self.unseen = math.log(1 / 36)  # no better than any character after any other

    def transitions(self, value: str) -> float:
        value = value.lower()
        steps = [self.log.get(x, self.unseen - 2) for x in zip(value, value[1:], strict=False)]
        return sum(steps) / len(steps) if steps else self.unseen

    def coverage(self, value: str) -> float:
        """Share of characters covered by dictionary words, the longest from the left."""
        value, at, covered = value.lower(), 0, 0
        while at < len(value):
            size = next((n for n in range(min(self.longest, len(value) - at), 2, -1) if value[at : at + n] in self.words), 0)
            covered += size
            at += size or 1
        return covered / len(value)


def _bucket(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.lower().encode()) % BUCKETS


def features(value: str, before: str, after: str, path: str, corpus: Corpus) -> list[float]:
    n = len(value)
    share = [v / n for v in Counter(value).values()]
    words = before.split()
    near = [*words[-3:], *after.split()[:1]]
    place = [0.0] * (2 * BUCKETS)
    for word in words[-2:]:
        place[_bucket(word.strip("\"'=:"))] = 1.0
    place[BUCKETS + _bucket(path.rpartition(".")[2])] = 1.0
    return [
        math.log(n),
        sum(c.isdigit() for c in value) / n,
        sum(c.isupper() for c in value) / n,
        sum(c in "+/=_-" for c in value) / n,
        sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:], strict=False)) / n,
        -sum(p * math.log2(p) for p in share),
        corpus.transitions(value),
        corpus.coverage(value),
        float(before.rstrip("\"' ")[-1:] in ("=", ":")),
        float(before[-1:] in ("\"", "'")),
        float(any(CREDENTIAL.search(w) for w in near)),
        float(before[-1:] in ("", " ", "\n")),
        float(SAMPLE_PATH.search(path) is not None),
        float(path.count("/")),
        *place,
    ]


def learn_corpus(docs: DataFrame, share: float = DICTIONARY_SHARE) -> Corpus:
    """Dictionary from the word counts of all rows of ``docs`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py() or ""))
                if len(held) > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
                    held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    counts = stored(docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "dictionary")
    least = max(2.0, share * (counts.agg(F.sum("n")).first()[0] or 0))
    words = [r["word"] for r in counts.where(F.col("n") >= least).select("word").collect()]
    return Corpus(words, {tuple(r["pair"]): r["n"] for r in _pairs(counts).collect()})


def _pairs(counts: DataFrame) -> DataFrame:
    """pair, n: neighbouring Latin letters in all words; some hundred letters squared at most."""
    letters = counts.where(F.length("word") > 1).select(F.split("word", "").alias("c"), "n")  # places of an array are found at once, those of a text by counting
    spread = F.expr("explode(transform(sequence(1, size(c) - 1), i -> concat(c[i - 1], c[i])))")
    pairs = letters.select(spread.alias("pair"), "n").where(F.col("pair").rlike(f"^[a-z{LATIN}]{{2}}$"))
    return pairs.groupBy("pair").agg(F.sum("n").alias("n"))


def candidates(docs: DataFrame, corpus: Corpus, path: str = "source") -> DataFrame:
    """doc_id, print, start, stop, finding, form (label by form or null), features of every candidate."""
    shared = docs.sparkSession.sparkContext.broadcast(corpus)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, (text, place) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                text, place = text.as_py(), place.as_py()
                for start, stop in candidates_of(text):
                    before, value = text[max(0, start - 60) : start], text[start:stop]
                    out.append((row, start, stop, value, form_label(value, before), features(value, before, text[stop : stop + 40], place, shared.value)))
            pick = pa.array([r[0] for r in out], pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.list_(pa.float64()))
            columns = [batch.column(0).take(pick), batch.column(1).take(pick)]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array([r[k + 1] for r in out], kind) for k, kind in enumerate(kinds)]], names=names)

    names = ["doc_id", "print", "start", "stop", "finding", "form", "features"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("print"), "text", where.alias("path"))
    return rows.mapInArrow(run, f"doc_id {kind}, print bigint, start int, stop int, finding string, form double, features array<double>")


def labelled_sample(known: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """features, label: at most ``most`` labelled findings of either label.

    The order is by place, not by string, so that a string has the share in the sample that it has in the corpus.
    """
    known = known.withColumn("h", F.xxhash64("doc_id", "print", "start", "finding"))
    order = [F.col(c) for c in ("h", "finding", "doc_id", "print", "start")]
    some = [known.where(F.col("label") == x).orderBy(*order).limit(most) for x in (0.0, 1.0)]
    return some[0].unionByName(some[1]).coalesce(1).sortWithinPartitions(*order)


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source", most_labelled: int = MOST_LABELLED, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """doc_id, print, start, stop, finding, score for every candidate in ``docs`` (doc_id, text and the path column)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    found = stored(candidates(docs, learn_corpus(docs), path), "secret-candidates")
    if labelled is None:
        known = found.where("form is not null").withColumn("label", F.col("form"))
    else:
        known = found.join(labelled.select("doc_id", "start", F.col("label").cast("double").alias("label")), ["doc_id", "start"])
    known = known.select("doc_id", "print", "start", "finding", "features", "label")
    sample = stored(labelled_sample(known, most_labelled), "labelled-findings")
    columns = ["doc_id", "print", "start", "stop", "finding"]
    if sample.select("label").distinct().count() < 2:
        return found.select(*columns, F.coalesce("form", F.lit(0.0)).alias("score"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featuresCol="vector", labelCol="label")
    model = forest.fit(sample.select(array_to_vector("features").alias("vector"), "label"))
    scored = model.transform(found.withColumn("vector", array_to_vector("features")))
    return scored.select(*columns, vector_to_array("probability")[1].alias("score"))


def redact(docs: DataFrame, threshold: float = THRESHOLD, mask: str = MASK, path: str = "source") -> DataFrame:
    """``docs`` with every finding of at least ``threshold`` replaced by ``mask``; n_chars, where there, follows the text."""
    found = scan(docs, path=path).where(F.col("score") >= threshold)
    spans = stored(found.groupBy("doc_id", "print").agg(F.sort_array(F.collect_set(F.struct("start", "stop")), asc=False).alias("spans")), "secret-spans")
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), F.col("spans").alias("_spans"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    text = F.col("row")["text"]
    joined = rows.join(spans, F.col("row")["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_print")), "left")
    cut = F.expr("aggregate(_spans, row.text, (t, s) -> concat(substring(t, 1, s.start), '" + mask.replace("'", "\\'") + "', substring(t, s.stop + 1)))")
    clean = F.when(F.col("_spans").isNull(), text).otherwise(cut)
    out = {c: F.col("row")[c] for c in docs.columns} | {"text": clean}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("_spans").isNull(), out["n_chars"]).otherwise(F.length(clean).cast(docs.schema["n_chars"].dataType))
    return joined.select(*[x.alias(c) for c, x in out.items()])


@query("op1_secret_forest")
def op1_secret_forest(spark, folder):
    """Secrets that the forest keeps, in all documents."""
    found = scan(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return found.where(F.col("score") >= THRESHOLD).select("doc_id", "start", "stop", "finding", "score")
