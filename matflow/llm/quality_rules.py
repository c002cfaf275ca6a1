"""Quality rules: counts of a text, and how far its characters and words are from those of a language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matflow.llm.blocks import NOT_ALPHANUMERIC, Block, Words, chain, covered, parts, range_hashes, runs, window_hashes

#: Most common words of a language that its word histogram has; all others share one bin.
COMMON_WORDS = 50
#: Languages whose references are still broadcast (about 1 KB each).
MOST_LANGUAGES = 1000
#: A text has to have so many words to be compared, and a language to be compared with.
LEAST_WORDS, LEAST_REFERENCE_WORDS = 50, 1000
#: Jensen-Shannon distances (0 to 1) beyond which a text is too far from every language.
MOST_CHARACTER_DISTANCE, MOST_WORD_DISTANCE = 0.21, 0.5

CLASSES = 10

_SYMBOLS = b"#*$%&|<>"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_TALLY = "lang string, word bigint, character int, n bigint"


def _character_classes() -> np.ndarray:
    """The class of each byte: lower, upper, digit, blank, line feed, sentence mark, symbol, bar or bracket, other, not ASCII.

    Bytes that continue a character are of the class after these, which does not count.
    """
    kinds = np.full(256, 8, np.uint8)
    for kind, members in enumerate((range(97, 123), range(65, 91), range(48, 58), b"\t\v\f\r ", b"\n", b".,;:?'\"()-", b"!#*$%&", b"|<>")):
        kinds[list(members)] = kind
    kinds[0xC0:] = CLASSES - 1
    kinds[0x80:0xC0] = CLASSES
    return kinds



def _class_counts(block: Block, kinds: np.ndarray) -> np.ndarray:
    """Characters of each class by text, without the line feed that follows a text."""
    ends = np.append(block.start[1:], len(block.data))
    text = np.repeat(np.arange(block.count) * 16, ends - block.start)
    counts = np.bincount(text + kinds[block.data], minlength=16 * block.count).reshape(-1, 16)[:, :CLASSES]
    counts[:, 4] -= 1  # the line feed after the text
    return counts


def _plain_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of lower-cased alphanumeric words, the text of each, and the number by text."""
    words = Words(Block(texts, _LOWER), NOT_ALPHANUMERIC)
    return words.hashes(), words.text, words.counts


def _by_text(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[ends] - total[starts]


def _equals_first(data: np.ndarray, start: np.ndarray, end: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Whether a range that has the hash of the ones before it has the bytes of the first of them, too."""
    found, raw = np.ones(len(start), bool), data.tobytes() if again.any() else b""
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(start))))
    for at in np.flatnonzero(again).tolist():
        own, other = slice(start[at], end[at]), slice(start[first[at]], end[first[at]])
        found[at] = raw[own] == raw[other]
    return found


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts of each text over words that ASCII white space ends.

    word_chars: characters in words. n_symbols: characters that are one of # * $ % & | < >. n_dup_lines: lines with
    a word that equal an earlier line. n_repeat_words: words in windows of three words that occur twice or more.
    """
    block = Block(texts)
    words = Words(block)
    ends = np.append(block.start[1:], len(block.data)) - 1
    blank = np.zeros(256, bool)
    blank[list(b"\t\n\v\f\r ")] = True
    in_word = ~blank[block.data]
    characters = in_word & ((block.data & 0xC0) != 0x80)
    symbol = np.zeros(256, bool)
    symbol[list(_SYMBOLS)] = True

    feeds = np.flatnonzero(block.data == 10)
    line_start = np.concatenate([[0], feeds[:-1] + 1])
    filled = _by_text(in_word, line_start, feeds) > 0
    line_text = block.text_of(line_start[filled])
    lines = chain(range_hashes(block.data, line_start[filled], feeds[filled]), line_text.astype(np.uint64))
    order = np.argsort(lines, kind="stable")
    again = np.ones(len(order), bool)
    again[runs(lines[order])] = False
    again &= _equals_first(block.data, line_start[filled][order], feeds[filled][order], again)

    whole = np.flatnonzero(words.whole(3))
    windows = chain(window_hashes(words.hashes(), 3)[whole], words.text[whole].astype(np.uint64))
    by_window = np.argsort(windows)
    first = runs(windows[by_window])
    sizes = np.diff(np.append(first, len(by_window)))
    repeated = whole[by_window[np.repeat(sizes > 1, sizes)]]
    marked = covered(repeated, 3, len(words.text))
    return {
        "n_words": words.counts,
        "word_chars": _by_text(characters, block.start, ends),
        "n_symbols": _by_text(symbol[block.data], block.start, ends),
        "n_dup_lines": np.bincount(line_text[order[again]], minlength=block.count),
        "n_repeat_words": np.bincount(words.text[marked], minlength=block.count),
    }


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of words and character classes by language."""
    kinds, order = _character_classes(), {}
    tallies: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    classes = np.zeros((0, CLASSES), np.int64)

    def rows(language: np.ndarray, words: np.ndarray | None, character: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
        names = np.array(list(order), object)
        empty = pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names[language], pa.string()),
                empty[0] if words is None else pa.array(words.view(np.int64)),
                empty[1] if character is None else pa.array(character.astype(np.int32)),
                pa.array(n.astype(np.int64)),
            ],
            ["lang", "word", "character", "n"],
        )

    def merged():
        language, words, n = (np.concatenate(x) for x in zip(*tallies))
        by = np.lexsort((words, language))
        language, words, n = language[by], words[by], n[by]
        changed = np.union1d(runs(words), runs(language))
        return language[changed], words[changed], np.add.reduceat(n, changed)

    for batch in batches:
        langs = batch.column(1).to_pylist()
        of_text = np.array([order.setdefault(lang, len(order)) for lang in langs], np.int64)
        if len(order) > len(classes):
            classes = np.concatenate([classes, np.zeros((len(order) - len(classes), CLASSES), np.int64)])
        for begin, end, texts in parts(batch.column(0)):
            np.add.at(classes, of_text[begin:end], _class_counts(Block(texts), kinds))
            words, text, _ = _plain_words(texts)
            language = of_text[begin:end][text]
            by = np.lexsort((words, language))
            words, language = words[by], language[by]
            changed = np.union1d(runs(words), runs(language)).astype(np.int64)
            if len(changed):
                tallies.append((language[changed], words[changed], np.diff(np.append(changed, len(words)))))
            if sum(len(tally[0]) for tally in tallies) > 1_500_000:
                tallies = [merged()]
                if len(tallies[0][0]) > 1_000_000:
                    language, words, n = tallies.pop()
                    yield rows(language, words, None, n)
    if tallies:
        language, words, n = merged()
        yield rows(language, words, None, n)
    language, character = np.nonzero(classes)
    yield rows(language, None, character, classes[language, character])


@dataclass(frozen=True)
class References:
    """Of each language the shares of its character classes, and its common words with the share of each and the rest."""

    characters: np.ndarray
    words: tuple[np.ndarray, ...]
    shares: tuple[np.ndarray, ...]


def fit_references(docs: DataFrame, common: int = COMMON_WORDS) -> References:
    """Histograms over all documents of each language. Documents without text or language do not count.

    Words that tie around the last place are all left out, so the order of equals doesn't matter. Languages of fewer
    than LEAST_REFERENCE_WORDS words have no reference. What is collected is a few rows for each
    language; more than MOST_LANGUAGES of them are an error.
    """
    known = docs.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = known.mapInArrow(_tally, _TALLY).groupBy("lang", "word", "character").agg(F.sum("n").alias("n"))
    words = counts.filter(F.col("word").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = words.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= common + 1).drop("rank")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    totals = totals.select("lang", F.lit(None).cast("bigint").alias("word"), F.lit(-1).alias("character"), "n")
    found = top.unionByName(counts.filter(F.col("character").isNotNull())).unionByName(totals)
    table = found.limit((MOST_LANGUAGES + 1) * (common + CLASSES + 2)).toArrow()
    by_lang: dict[str, tuple[dict, np.ndarray, list]] = {}
    for lang, word, character, n in zip(*(table.column(c).to_pylist() for c in ("lang", "word", "character", "n"))):
        of_word, of_class, total = by_lang.setdefault(lang, ({}, np.zeros(CLASSES), [0]))
        if word is not None:
            of_word[word] = n
        elif character < 0:
            total[0] = n
        else:
            of_class[character] = n
    if len(by_lang) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    kept = [by_lang[lang] for lang in sorted(by_lang) if by_lang[lang][2][0] >= LEAST_REFERENCE_WORDS]
    characters, listed, shares = [], [], []
    for of_word, of_class, (total,) in kept:
        if len(of_word) > common:
            least = min(of_word.values())
            of_word = {word: n for word, n in of_word.items() if n > least}
        hashes = np.sort(np.array(list(of_word), np.int64).view(np.uint64))
        n = np.array([of_word[h] for h in hashes.view(np.int64).tolist()], float)
        characters.append(of_class / of_class.sum())
        listed.append(hashes)
        shares.append(np.append(n, total - n.sum()) / total)
    return References(np.array(characters).reshape(-1, CLASSES), tuple(listed), tuple(shares))


def jensen_shannon(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The distance (square root of the divergence in bits) of each row of counts from a distribution; 0 for no counts."""
    total = counts.sum(axis=1, keepdims=True)
    own = counts / np.maximum(total, 1)
    middle = (own + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(own > 0, own * np.log2(own / middle), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / middle), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(left + right, 0) / 2), 0)


def distances(texts: list[bytes], references: References, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distances of each text's characters and words from the closest language; 0 without any reference."""
    if not references.words:
        return np.zeros(len(texts)), np.zeros(len(texts))
    classes = _class_counts(Block(texts), kinds)
    words, text, counts = _plain_words(texts)
    characters, of_words = [], []
    for share, listed, word_share in zip(references.characters, references.words, references.shares):
        characters.append(jensen_shannon(classes, share))
        at = np.searchsorted(listed, words)
        at[(at == len(listed)) | (listed[np.minimum(at, len(listed) - 1)] != words)] = len(listed)
        bins = len(listed) + 1
        of_words.append(jensen_shannon(np.bincount(text * bins + at, minlength=bins * len(texts)).reshape(-1, bins), word_share))
    return np.min(characters, axis=0), np.min(of_words, axis=0)


def judge(docs: DataFrame, references: References, text: str = "text") -> Column:
    """A struct of the base counts and the two distances of each text."""
    shared = docs.sparkSession.sparkContext.broadcast((references.characters, references.words, references.shares))

    def measured(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, kinds = References(*shared.value), _character_classes()
        for column in columns:
            found = [{**base_counts([]), "character_distance": np.zeros(0), "word_distance": np.zeros(0)}]
            for _, _, piece in parts(column):
                counts = base_counts(piece)
                counts["character_distance"], counts["word_distance"] = distances(piece, known, kinds)
                found.append(counts)
            names = list(found[0])
            joined = {name: np.concatenate([part[name] for part in found]) for name in names}
            arrays = [pa.array(joined[n], pa.float64() if n.endswith("distance") else pa.int64()) for n in names]
            yield pa.StructArray.from_arrays(arrays, names)

    measured.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(measured, f"{_COUNTS}, character_distance double, word_distance double")(F.col(text))


def apply_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, base counts, base_failed, kept, character_distance, word_distance) of every document.

    A document fails the base rules with fewer than 50 words, or if more than half of its words are in repeated
    windows. Others are kept if their character classes and common words are near those of some language. A
    missing text has no words. Repeated rows give repeated results.
    """
    rows = docs.select("doc_id", judge(docs, fit_references(docs)).alias("m")).select("doc_id", "m.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.col("character_distance") <= MOST_CHARACTER_DISTANCE) & (F.col("word_distance") <= MOST_WORD_DISTANCE)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & near).alias("kept"),
        "character_distance",
        "word_distance",
    )
