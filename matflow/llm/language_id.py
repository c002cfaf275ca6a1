"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matflow.llm.blocks import parts, runs

BUCKETS = 1 << 15
SMOOTHING = 0.05
UNKNOWN = "und"
#: Characters whose n-grams are made at once, and languages whose counters a task keeps.
SLICE, DENSE = 1 << 20, 16
#: Languages whose log-probabilities are still broadcast: 4 bytes x BUCKETS each, 64 MB in all.
MOST_LANGUAGES = 512

_COUNTS = "lang string, bucket int, n bigint"
_PREDICTION = "lang_pred string, score double"


def _letter_table() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def _hashed_ngrams(texts: list[bytes], letters: np.ndarray, buckets: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The buckets of the 1-, 2- and 3-grams around every letter, and the text of each letter, a slice at a time.

    Letters are lower-cased and whatever is no letter counts as one space. A slice has about ``SLICE`` characters of one
    or more texts and sees one more on both sides, so it doesn't matter where a long text is cut.
    """
    lowered = [text.decode("utf-8", "replace").lower() for text in texts]
    joined = "\n" + "\n".join(lowered) + "\n"
    ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    shift = np.uint32(32 - buckets.bit_length() + 1)
    for begin in range(1, len(joined) - 1, SLICE):
        piece = joined[begin - 1 : begin + SLICE + 1]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters[codes]
        at = np.flatnonzero(is_letter[1:-1]) + 1
        text = np.searchsorted(ends, at + begin - 2, "right")
        seen = np.where(is_letter, codes, np.uint32(0))
        before, here, after = seen[at - 1], seen[at], seen[at + 1]
        pair = before * np.uint32(0x9E3779B1) + here
        triple = pair * np.uint32(0x85EBCA77) + after
        keys = (here * np.uint32(0xC2B2AE3D), pair * np.uint32(0x27D4EB2F) + np.uint32(1), triple * np.uint32(0x165667B1))
        yield [(((key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> shift).astype(np.int32) for key in keys], text


def _count_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a task's rows, and with bucket -1 the documents of each language.

    The first ``DENSE`` languages have a row of counters; counts of others leave the task with the slice they are from.
    """
    letters = _letter_table()
    order: dict[str, int] = {}
    counts = np.zeros((DENSE, buckets), np.int64)

    def found(names: list[str], of: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        langs = pa.array(names, pa.string()).take(pa.array(of))
        return pa.RecordBatch.from_arrays([langs, pa.array(bucket.astype(np.int32)), pa.array(n)], ["lang", "bucket", "n"])

    for batch in batches:
        langs = batch.column(1).to_pylist()
        for lang in langs:
            if lang not in order and len(order) < DENSE:
                order[lang] = len(order)
        others = sorted(set(langs).difference(order))
        place = {**order, **{lang: DENSE + n for n, lang in enumerate(others)}}
        names = [*order, *[""] * (DENSE - len(order)), *others]
        of_text = np.fromiter((place[lang] for lang in langs), np.int64, len(langs))
        which, documents = np.unique(of_text, return_counts=True)
        yield found(names, which, np.full(len(which), -1), documents)
        for begin, end, texts in parts(batch.column(0)):
            for grams, text in _hashed_ngrams(texts, letters, buckets):
                own = of_text[begin:end][text]
                few, rare = own < DENSE, own >= DENSE
                for gram in grams:
                    counts += np.bincount(own[few] * buckets + gram[few], minlength=counts.size).reshape(counts.shape)
                if rare.any():
                    keys = np.concatenate([own[rare] * buckets + gram[rare] for gram in grams])
                    keys, n = np.unique(keys, return_counts=True)
                    yield found(names, keys // buckets, keys % buckets, n)
    for lang, row in order.items():
        some = np.flatnonzero(counts[row])
        yield found([lang], np.zeros(len(some), np.int64), some, counts[row][some])


@dataclass(frozen=True)
class LanguageModel:
    """``log_probability`` has a row for each bucket and a column for each of ``languages``."""

    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_probability: np.ndarray

    def score(self, column: pa.Array, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text (the first one of a tie) and its posterior probability."""
        best, score = np.full(len(column), -1), np.zeros(len(column))
        if self.languages:
            limit = (8 << 20) // len(self.languages)
            for begin, end, texts in parts(column, max(limit, 1 << 14)):
                total, some = np.zeros((end - begin, len(self.languages))), np.zeros(end - begin, bool)
                for grams, text in _hashed_ngrams(texts, letters, len(self.log_probability)):
                    first = runs(text)
                    for low in range(0, len(text), step := max(limit, 1 << 14)):  # the rows of so many letters at once
                        cut = first[(first > low) & (first < low + step)] - low
                        cut = np.concatenate([np.zeros(1, np.int64), cut])
                        rows = text[low:][cut]
                        for gram in grams:
                            values = self.log_probability[gram[low : low + step]]
                            total[rows] += np.add.reduceat(values, cut, axis=0, dtype=np.float64)
                        some[rows] = True
                total = total[some] + self.log_prior
                at = begin + np.flatnonzero(some)
                best[at] = total.argmax(axis=1)
                score[at] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if b >= 0 else UNKNOWN for b in best], score


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> LanguageModel:
    """N-gram counts of every document with a language; rows without text or language teach nothing.

    Tasks send one row for each language and bucket they have seen, so what is collected is at most
    languages x buckets counts. More than ``MOST_LANGUAGES`` languages are an error, as the model is broadcast.
    """
    known = docs.select(F.col(text), F.col(lang)).filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counted = known.mapInArrow(lambda batches: _count_batches(batches, buckets), _COUNTS)
    totals = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    most = (MOST_LANGUAGES + 1) * (buckets + 1)
    table = totals.limit(most).toArrow()
    languages = tuple(sorted(set(table.column("lang").to_pylist())))
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    place = {name: at for at, name in enumerate(languages)}
    column = np.fromiter((place[x] for x in table.column("lang").to_pylist()), np.int64, len(table))
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    counts, prior = np.zeros((buckets, len(languages))), np.zeros(len(languages))
    prior[column[bucket < 0]] = n[bucket < 0]
    counts[bucket[bucket >= 0], column[bucket >= 0]] = n[bucket >= 0]
    smooth = counts + SMOOTHING
    log_probability = np.log(smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32)
    return LanguageModel(languages, np.log(prior / max(prior.sum(), 1)), log_probability)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """A struct (lang_pred, score) for each row: ``und`` and 0 where the text is null or has no letter."""
    # Plain arrays: a broadcast is unpickled without this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, model.log_probability))

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters, learned = _letter_table(), LanguageModel(*shared.value)
        for column in columns:
            langs, scores = learned.score(column, letters)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    score.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, _PREDICTION)(F.col(text))


def held_out(id_column: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether the crc32 of the id as text falls into the fold that is not learned from; never null."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % folds == fold, F.lit(False))


def identify_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from those that are not held out.

    Repeated rows give repeated results. Without any row to learn from, every document is ``und``. A
    missing doc_id is not held out.
    """
    model = fit(docs.filter(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), predict(docs, model).alias("__found"))
    return scored.select("doc_id", "held_out", "__found.lang_pred", "__found.score")
