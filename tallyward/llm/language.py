"""Operator 3: language by multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 3-grams are summed for each language, first within a task, then by Spark;
the model is a matrix of log probabilities with BUCKETS rows and a column for each learned
language, whatever the number of documents, and is broadcast. A batch is a sparse matrix, how often
each text has each bucket; its product with the model is taken BLOCK entries at a time.

Everything but letters counts as a blank; letters are lower-cased. The language is the one of the
largest log prior and likelihood of the whole text. Neighbouring n-grams overlap and are no
independent evidence, so only the score (never the language) is tempered: it is that language's
posterior for EVIDENCE n-grams' worth of the text's mean.

Contract: learns only from rows with a lang, a text and a doc_id whose crc32 mod FOLDS is not
HELD. Null text, or none with a letter: lang_pred und, score 0. If nothing can be learned, all
rows are und. Ties go to the first language by name. A null doc_id is neither held out nor
learned from. Repeated rows count as often as they occur. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.tables import free_name, slices, stored, worker_cache

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
EVIDENCE = 64
FOLDS, HELD = 3, 1
UNKNOWN = "und"
CHARACTERS = 250_000  # characters whose n-grams are held at once
BLOCK = 1 << 14  # entries of the sparse product at a time
LANGUAGES_HELD = 32  # count vectors that a task keeps before it passes them on

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000))
    return _LETTERS[0]


def features(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams (an array for each order), the start of each text, letters in each.

    Each text ends with a blank, so that no text is empty; an n-gram that reaches beyond its text
    reads blanks."""
    texts = [t.lower() for t in texts]
    joined = " ".join(texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    code = np.where(letter, points, 32).astype(np.uint64)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begin = np.cumsum(sizes) - sizes
    last = np.cumsum(sizes) - 1
    out, value = [], np.zeros(len(code), np.uint64)
    with np.errstate(over="ignore"):
        for order in range(1, max(ORDERS) + 1):
            ahead = np.full(len(code), 32, np.uint64)
            ahead[:len(code) - order + 1] = code[order - 1:]
            for back in range(order - 1):  # the last places of a text do not read the next one
                ahead[np.maximum(last - back, begin)] = 32
            value = value * np.uint64(0x100000001B3) + ahead + np.uint64(order)
            if order in ORDERS:
                out.append(((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % buckets)
    return np.stack(out), begin, np.add.reduceat(letter.astype(np.int64), begin)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """lang, bucket and n: n-grams of ``rows`` (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, total in held.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                    names=["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs) if x == lang]
                total = held.setdefault(lang, np.zeros(buckets, np.int64))
                for a, b in slices(own, CHARACTERS):
                    found, _, _ = features(own[a:b], buckets)
                    total += np.bincount(found.ravel(), minlength=buckets)
            if len(held) > LANGUAGES_HELD:
                yield from out()
        yield from out()

    parts = rows.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages, log prior and log probability of each bucket (a row) in each language."""

    def __init__(self, languages: list[str], prior: np.ndarray, weights: np.ndarray):
        self.languages, self.prior, self.weights = languages, prior, weights

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score, and whether there is a letter."""
        buckets = len(self.weights)
        found, begin, letters = features(texts, buckets)
        text = np.repeat(np.arange(len(texts)) * buckets, np.diff(np.append(begin, found.shape[1])))
        entries, times = np.unique((found + text).ravel(), return_counts=True)
        total = np.zeros((len(texts), len(self.languages)))
        for a in range(0, len(entries), BLOCK):
            row, bucket = np.divmod(entries[a:a + BLOCK], buckets)
            first = np.flatnonzero(np.diff(row, prepend=-1))
            parts = self.weights[bucket] * times[a:a + BLOCK, None].astype(np.float32)
            total[row[first]] += np.add.reduceat(parts, first, axis=0, dtype=np.float64)
        n = np.diff(np.append(begin, found.shape[1])) * len(found)
        best = (self.prior + total).argmax(axis=1)
        tempered = self.prior + total * np.minimum(1, EVIDENCE / n)[:, None]
        share = np.exp(tempered - tempered.max(axis=1, keepdims=True))
        return best, share[np.arange(len(texts)), best] / share.sum(axis=1), letters > 0


def learn(docs: DataFrame, buckets: int = BUCKETS) -> Model | None:
    """The model of the rows that may be learned from. The driver gets the summed counts: at most
    ``buckets`` numbers for each language."""
    rows = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
                       & F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = stored(counts(rows, buckets), "language-counts").toPandas()
    if found.empty:
        return None
    seen = rows.groupBy("lang").count().toPandas().set_index("lang")["count"]
    languages = sorted(seen.index)
    table = np.zeros((buckets, len(languages)))
    column = {x: i for i, x in enumerate(languages)}
    table[found["bucket"], found["lang"].map(column)] = found["n"]
    weights = np.log(table + SMOOTHING) - np.log(table.sum(axis=0) + SMOOTHING * buckets)
    prior = np.log(seen.loc[languages].to_numpy() / seen.sum())
    return Model(languages, prior, weights.astype(np.float32))


def with_language(docs: DataFrame, model: Model | None, language: str, score: str) -> DataFrame:
    """``docs`` with two more columns, of these names. No shuffle: rows are scored where they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    names = [*docs.columns, language, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        worker_cache("language")
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            langs, scores = [], []
            for a, b in slices(texts, CHARACTERS):
                if own is None:
                    langs += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                best, share, letters = own.score(texts[a:b])
                langs += [own.languages[i] if x else UNKNOWN for i, x in zip(best.tolist(), letters.tolist())]
                scores += np.where(letters, np.minimum(share, 1.0), 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return with_language(rows, learn(docs), "lang_pred", "score").drop("text")


def known_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter, with all their columns; where there is a lang
    column that is null, the predicted language is put in. Where nothing can be learned the rows are
    kept as they are: a table without labels says nothing against its texts."""
    language, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    model = learn(docs)
    told = F.lit(None) if model is None else F.col(language)
    model = model or Model([UNKNOWN], np.zeros(1), np.zeros((1, 1), np.float32))  # one language: tells letters only
    return with_language(docs, model, language, score).filter(F.col(score) > 0).select(*[
        F.coalesce(F.col(c), told).alias(c) if c == "lang" else F.col(c) for c in docs.columns])
