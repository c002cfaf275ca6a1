"""Licence scan: passages of a text against licence templates by the Dice coefficient of their word bigrams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matflow.llm.blocks import NOT_ALPHANUMERIC, Block, Words, chain, parts

#: Least Dice coefficient of a match.
LEAST_DICE = 0.85

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_FOUND = "n_words bigint, matches array<struct<license: string, dice: double, first_word: int, last_word: int>>"


def _bigrams(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of lower-cased letters and digits, where a bigram begins, and its hash."""
    words = Words(Block(texts, _LOWER), NOT_ALPHANUMERIC)
    hashes = words.hashes()
    at = np.flatnonzero(words.whole(2))
    return words, at, chain(hashes[at], hashes[at + 1])


@dataclass(frozen=True)
class Templates:
    """Bigrams of the templates: all different ones, sorted, and of each template how often it has which."""

    names: tuple[str, ...]
    known: np.ndarray
    counts: tuple[dict[int, int], ...]
    sizes: tuple[int, ...]
    has: np.ndarray

    def bounds(self, template: int, least: float) -> tuple[int, int]:
        """The fewest shared bigrams and the most bigrams of a passage whose Dice coefficient is high enough.

        A passage of p bigrams shares at most min(p, size), so 2 min(p, size) / (p + size) bounds the coefficient.
        """
        size = self.sizes[template]
        return ceil(size * least / (2 - least) - 1e-9), int(size * (2 - least) / least + 1e-9)


def prepare(templates: Sequence[tuple[str, str]]) -> Templates:
    """Templates of fewer than two words are left out."""
    rows = [(name, _bigrams([text.encode()])[2]) for name, text in templates]
    rows = [(name, bigrams) for name, bigrams in rows if len(bigrams)]
    known = np.unique(np.concatenate([bigrams for _, bigrams in rows] or [np.zeros(0, np.uint64)]))
    counts = [Counter(np.searchsorted(known, bigrams).tolist()) for _, bigrams in rows]
    has = np.zeros((len(rows), len(known)), bool)
    for at, count in enumerate(counts):
        has[at, list(count)] = True
    return Templates(tuple(name for name, _ in rows), known, tuple(map(dict, counts)), tuple(len(b) for _, b in rows), has)


def _passages(places: list[int], bigrams: list[int], template: int, templates: Templates, least: float):
    """(dice, words, template, first, last) of the best passage from each bigram of the template, in bigram numbers.

    ``places`` are where the text has bigrams of the template. A passage begins and ends with one.
    """
    size, wanted = templates.sizes[template], templates.counts[template]
    fewest, most = templates.bounds(template, least)
    for begin in range(len(places) - fewest + 1):
        if places[begin + fewest - 1] - places[begin] >= most:
            continue
        seen: dict[int, int] = {}
        shared, best = 0, None
        for end in range(begin, len(places)):
            length = places[end] - places[begin] + 1
            if length > most:
                break
            bigram = bigrams[end]
            seen[bigram] = seen.get(bigram, 0) + 1
            shared += seen[bigram] <= wanted[bigram]
            dice = 2 * shared / (length + size)
            if dice >= least and (best is None or dice > best[0]):
                best = (dice, length, template, places[begin], places[end])
        if best:
            yield best


def _apart(passages: list) -> list:
    """The passages by falling coefficient, then length, without those that overlap a better one."""
    kept: list = []
    taken: set[int] = set()
    for passage in sorted(passages, key=lambda p: (-p[0], -p[1], p[2], p[3])):
        span = range(passage[3], passage[4] + 1)
        if not taken.intersection(span):
            taken.update(span)
            kept.append(passage)
    return kept


def scan(texts: list[bytes], templates: Templates, least: float = LEAST_DICE) -> tuple[np.ndarray, list[list[dict]]]:
    """The number of words of each text, and its licence passages."""
    words, at, hashes = _bigrams(texts)
    found: list[list[dict]] = [[] for _ in texts]
    if not len(templates.known):
        return words.counts, found
    place = np.minimum(np.searchsorted(templates.known, hashes), len(templates.known) - 1)
    hit = templates.known[place] == hashes
    at, bigram = at[hit], place[hit]
    text = words.text[at]
    raw: dict[int, list] = {}
    for template in range(len(templates.names)):
        own = np.flatnonzero(templates.has[template][bigram])
        fewest, _ = templates.bounds(template, least)
        # Too short a text, or one with too few bigrams of the template, cannot match.
        number = np.bincount(text[own], minlength=len(texts))
        for row in np.flatnonzero((number >= max(fewest, 1)) & (words.counts > fewest)).tolist():
            mine = own[np.searchsorted(text[own], row) : np.searchsorted(text[own], row, "right")]
            places = (at[mine] - words.first[row]).tolist()
            raw.setdefault(row, []).extend(_passages(places, bigram[mine].tolist(), template, templates, least))
    for row, passages in raw.items():
        found[row] = [
            {"license": templates.names[t], "dice": dice, "first_word": first, "last_word": last + 1}
            for dice, _, t, first, last in _apart(passages)
        ]
    return words.counts, found


def find_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]], least: float = LEAST_DICE) -> DataFrame:
    """(doc_id, n_words, matches) of every document: its licence passages, best first, as ranges of words.

    A passage is any run of words whose bigrams, counted with repeats, have a Dice coefficient of at least
    ``least`` with those of a template; of overlapping passages the better one counts. Case and punctuation don't
    matter. The templates are a parameter and travel with the tasks. A missing or empty text has no passages.
    Repeated rows give repeated results.
    """
    known = prepare(templates)
    fields = (known.names, known.known, known.counts, known.sizes, known.has)
    shared = docs.sparkSession.sparkContext.broadcast(fields)

    def scanned(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Templates(*shared.value)
        kind = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32())])
        for column in columns:
            sizes, matches = [np.zeros(0, np.int64)], []
            for _, _, texts in parts(column):
                counts, found = scan(texts, own, least)
                sizes.append(counts)
                matches.extend(found)
            lists = pa.array(matches, pa.list_(kind))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(sizes)), lists], ["n_words", "matches"])

    scanned.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    rows = docs.select("doc_id", F.arrow_udf(scanned, _FOUND)(F.col("text")).alias("found"))
    return rows.select("doc_id", "found.n_words", "found.matches")


def license_report(docs: DataFrame, templates: Sequence[tuple[str, str]], least: float = LEAST_DICE) -> DataFrame:
    """(doc_id, n_words, license, dice, licenses, n_matches) of every document; license and dice are of its best passage."""
    found = find_licenses(docs, templates, least)
    names = F.array_sort(F.array_distinct("matches.license"))
    return found.select(
        "doc_id",
        "n_words",
        F.get("matches", 0)["license"].alias("license"),
        F.get("matches", 0)["dice"].alias("dice"),
        F.concat_ws(",", names).alias("licenses"),
        F.size("matches").cast("bigint").alias("n_matches"),
    )
