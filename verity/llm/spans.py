"""Substring near-verbatim dedup by sliding sentence spans.

A text is cut into sentences, one of more than ``LONG`` words into parts. The
parts begin where the words themselves say so (see ``cut``), so a passage is
cut the same way wherever it stands in a sentence. From every sentence or part
on, and up to every one, the shortest run of at least ``MIN_SENTENCES`` of them and ``MIN_WORDS``
words (``MIN_WORDS_INSIDE`` within a single sentence) is a span; it is hashed by its
words, case folded. All spans of all documents are joined on their hash. The first place
of a span (smallest doc_id, then text, then position) keeps it; sentences that
any other place covers are removed.

Two copies of a passage are cut alike from at most ``LONG`` words after its
beginning to ``LONG`` words before its end, where its line ends are the same.
So 50 words that occur twice share at least one span.

Only hashes and places are shuffled for the join; counting is pre-aggregated,
and the join back to the places is a plain equi-join whose hot hashes AQE
splits. Spans that occur once end there.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import Staging, bound_arrow_batches, text_of

MIN_SENTENCES = 2
MIN_WORDS = 16
MIN_WORDS_INSIDE = 25
LONG = 12

# Code points that str.split() splits at; all lie below 0x3001.
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)])


_BASE, _INVERSE, _MIX = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64(0xBF58476D1CE4E5B9)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _words_at(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of every word, and one past its last."""
    space = np.ones(len(code) + 2, bool)
    space[1:-1] = _SPACE[np.minimum(code, 0x3000)] & (code <= 0x3000)
    turn = np.flatnonzero(space[1:] != space[:-1])
    return turn[::2], turn[1::2]


@functools.lru_cache(2)
def _powers_up_to(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    # Kept for the next batch, in a rounded size.
    return _powers_up_to(base, 1 << n.bit_length())[:n]


def _word_hashes(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The upper 32 bits of a mixed polynomial (modulo 2^64) in the characters
    of each word, from prefix sums over all of them."""
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(code * _powers(_BASE, len(code)), dtype=np.uint64, out=total[1:])
    value = (total[end] - total[start]) * _powers(_INVERSE, len(code) + 1)[start]
    value = (value ^ (value >> np.uint64(29))) * _MIX
    return (value ^ (value >> np.uint64(32))) * _MIX >> np.uint64(32)


class Cut(NamedTuple):
    """The units of some texts, one after the other: sentences with a word, of
    a sentence above ``LONG`` words its parts. ``edge``, ``begin`` and ``end``
    are by unit, ``unit`` by text."""
    words: list[str]  # folded, of all texts; none if not asked for
    edge: np.ndarray  # first word of each unit, and the number of words
    begin: np.ndarray  # characters within the text
    end: np.ndarray
    sentence: np.ndarray  # number of its sentence
    unit: np.ndarray  # first unit of each text, and the number of units


def cut(texts: list[str], with_words: bool = True) -> Cut:
    """A sentence ends after a word that ends in stops, or at a line's end. In
    every window of ``LONG`` words within a longer sentence the word with the
    smallest hash (the first of equals) begins a part, so no cut depends on
    words ``LONG`` or more away."""
    # Texts meet at line ends, where a sentence ends anyway.
    whole = "\n".join(texts)
    low = whole.lower()
    words = low.split() if with_words else []
    code = _codes(whole)
    start, end = _words_at(code)
    n = len(start)
    at = np.cumsum([0, *(len(text) + 1 for text in texts)])
    first = np.searchsorted(start, at)
    last = code[end - 1]
    opens = np.ones(n + 1, bool)
    opens[1:] = (last == 46) | (last == 33) | (last == 63)
    opens[np.searchsorted(end, np.flatnonzero(code == 10), "right")] = True
    opens = opens[:n]
    number = np.cumsum(opens) - 1  # of the sentence of each word
    cuts = opens.copy()
    if n > LONG:
        # No character becomes fewer: with equal lengths, words keep their places.
        hashes = (_word_hashes(_codes(low), start, end) if len(low) == len(whole) else
                  _word_hashes(_codes(low), *_words_at(_codes(low))))
        key = hashes << np.uint64(32) | np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= LONG:
            key, width = np.minimum(key[:-width], key[width:]), 2 * width
        key = np.minimum(key[:n - LONG + 1], key[LONG - width:])
        inside = (number[:n - LONG + 1] == number[LONG - 1:]) & (np.bincount(number)[number[:n - LONG + 1]] > LONG)
        cuts[(key[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    begins = np.flatnonzero(cuts)
    edge = np.append(begins, n)
    unit = np.searchsorted(begins, first)
    shift = np.repeat(at[:-1], np.diff(unit))
    return Cut(words, edge, start[begins] - shift, (end[edge[1:] - 1] if n else end) - shift, number[begins], unit)


def units_of(found: Cut, k: int) -> list[tuple[int, int, list[str], int]]:
    """(start, end, folded words, number of the sentence) of the units of the
    ``k``-th text, in order."""
    low, high = found.unit[k], found.unit[k + 1]
    edge = found.edge[low:high + 1].tolist()
    return [(s, e, found.words[a:b], n) for s, e, a, b, n in zip(
        found.begin[low:high].tolist(), found.end[low:high].tolist(), edge, edge[1:], found.sentence[low:high].tolist())]


def sentences(text: str) -> list[tuple[int, int, list[str], int]]:
    return units_of(cut([text]), 0)


def runs(edge: np.ndarray, sentence: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First unit, and one past the last, of every span, in order; the
    arguments are those of ``Cut``. A run is long enough when it holds two
    units, and ``MIN_WORDS`` over a sentence's end or ``MIN_WORDS_INSIDE``;
    longer ones around it then are, too."""
    n = len(sentence)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
    own = np.searchsorted(opens, np.arange(n), "right") - 1
    each = np.arange(n)
    # From each unit on: the least end.
    after = np.append(opens, n + 1)[own + 1] + 1  # holds the next sentence's first unit
    end = np.minimum(np.searchsorted(edge, edge[:-1] + MIN_WORDS_INSIDE),
                     np.maximum(np.searchsorted(edge, edge[:-1] + MIN_WORDS), after))
    end = np.maximum(end, each + MIN_SENTENCES)
    last = unit[np.searchsorted(unit, each, "right")]  # of the text
    # Up to each unit: the greatest beginning.
    before = opens[own] - 1
    begin = np.maximum(np.searchsorted(edge, edge[1:] - MIN_WORDS_INSIDE, "right") - 1,
                       np.minimum(np.searchsorted(edge, edge[1:] - MIN_WORDS, "right") - 1, before))
    begin = np.minimum(begin, each + 1 - MIN_SENTENCES)
    low = unit[np.searchsorted(unit, each, "right") - 1]
    on, up = end <= last, begin >= low
    both = np.unique(np.concatenate([each[on] * (n + 1) + end[on], begin[up] * (n + 1) + each[up] + 1]))
    return both // (n + 1), both % (n + 1)


def digests(words: list[str], edge: np.ndarray, i: np.ndarray, j: np.ndarray) -> bytes:
    """The 128-bit hashes of the spans' words, with one space between."""
    joined = " ".join(words).encode("utf-8", "surrogatepass")
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    start = np.append(0, gaps + 1)[edge[i]].tolist()
    end = np.append(gaps, len(joined))[edge[j] - 1].tolist()
    return b"".join([xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(start, end)])


def spans(units: list[tuple[int, int, list[str], int]]) -> Iterator[tuple[int, int, int]]:
    """(first unit, one past the last, hash) of the spans of one text."""
    edge = np.cumsum([0, *(len(u[2]) for u in units)])
    i, j = runs(edge, np.array([u[3] for u in units], np.int64), np.array([0, len(units)]))
    found = digests([w for u in units for w in u[2]], edge, i, j)
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        yield a, b, int.from_bytes(found[16 * k:16 * k + 16], "big")


def text_key(text: str) -> int:
    """31 bits that tell rows of one doc_id apart."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 33


HASHES = "h1 long, h2 long"
PLACES = f"{HASHES}, doc_id long, place long, n_units int"


def _places(batches: Iterator[pa.RecordBatch], whole: bool = True) -> Iterator[pa.RecordBatch]:
    """doc_id, text to one row a span: hash, and with ``whole`` the document,
    place (text key and first sentence) and number of sentences."""
    for batch in batches:
        batch = batch.filter(batch.column(0).is_valid())
        texts = batch.column(1).to_pylist()
        found = cut(texts)
        i, j = runs(found.edge, found.sentence, found.unit)
        halves = np.frombuffer(digests(found.words, found.edge, i, j), ">i8").astype(np.int64).reshape(-1, 2)
        columns = [pa.array(halves[:, 0]), pa.array(halves[:, 1])]
        if whole:
            text = np.searchsorted(found.unit, i, "right") - 1
            keys = np.array([text_key(t) << 32 for t in texts], np.int64)
            columns += [batch.column(0).take(pa.array(text)), pa.array(keys[text] | (i - found.unit[text])),
                        pa.array(j - i, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc_id", "place", "n_units"][:len(columns)])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _places(batches, whole=False)


CLEANED = ("doc_id long, n_sentences long, n_removed long, changed boolean, "
           "removed array<struct<start:int,end:int>>, text string")


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, covered (place and sentences of the later spans) to the
    cleaned rows."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        done = cut(texts, with_words=False)
        unit = done.unit.tolist()
        n_removed, ranges = [0] * len(texts), [[] for _ in texts]
        for k, (text, covered) in enumerate(zip(texts, batch.column(2).to_pylist())):
            if not covered:
                continue
            gone = np.zeros(unit[k + 1] - unit[k], bool)
            key = text_key(text)
            for c in covered:
                if c["place"] >> 32 == key:
                    i = c["place"] & 0xFFFFFFFF
                    gone[i:i + c["n_units"]] = True
            turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
            starts, ends = done.begin[unit[k] + turn[::2]].tolist(), done.end[unit[k] + turn[1::2] - 1].tolist()
            n_removed[k] = int(gone.sum())
            ranges[k] = [{"start": a, "end": b} for a, b in zip(starts, ends)]
            texts[k] = "".join([text[a:b] for a, b in zip([0, *ends], [*starts, len(text)])])
        changed = [n > 0 for n in n_removed]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(np.diff(done.unit), pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(changed, pa.bool_()),
            pa.array(ranges, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            pa.array(texts, pa.string())], names=["doc_id", "n_sentences", "n_removed", "changed", "removed", "text"])


def remove_repeated_spans(docs: DataFrame, staging: Staging | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_sentences, n_removed, changed,
    removed`` (character ranges of the original text) and the cleaned
    ``text``.

    A copy of a whole document loses all its spans, so what is left of it are
    at most the sentences no span covers. A passage repeated inside one
    document loses its later places too. Rows that share doc_id and text are
    one document and keep or lose the same sentences; rows that share only the
    doc_id are told apart by their text. A null or empty text has no sentence
    and stays empty; a null doc_id is left as it is. Other columns are not
    read.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    staging = staging or Staging(spark, "spans")
    rows = docs.select(F.col("doc_id").cast("long"), text_of("text").cast("string").alias("text"))
    places = rows.mapInArrow(_places, PLACES)
    # First only the hashes, to know which occur twice; the rest of a place
    # travels for those alone.
    hashes = rows.mapInArrow(_hashes, HASHES)
    twice = staging.write(hashes.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2"),
                          "twice")
    found = staging.write(places.join(twice, ["h1", "h2"]), "found")
    # A table of its own, so that the join back may split a hot hash.
    first = staging.write(found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "place")).alias("first")), "first")
    later = (found.join(first, ["h1", "h2"])
             .filter(F.struct("doc_id", "place") != F.col("first")).select("doc_id", "place", "n_units").distinct())
    covered = later.groupBy("doc_id").agg(F.collect_list(F.struct("place", "n_units")).alias("covered"))
    return rows.join(covered, "doc_id", "left").select("doc_id", "text", "covered").mapInArrow(_clean, CLEANED)
