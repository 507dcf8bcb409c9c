"""Quality rules by compression bands.

Text that a general compressor shrinks far more than prose repeats itself;
text that it hardly shrinks is random, encoded or encrypted. The ratio (raw
bytes / zstandard bytes) of prose depends on the length, so a band of ratios
belongs to each range of lengths. A document is kept when the whole text is
inside its band and not too much of it lies in fixed chunks outside theirs
(a chunk catches a bad part that a long document averages away).

The rows are independent: the work runs in Arrow batches of bounded bytes,
without a shuffle.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import bound_arrow_batches

LEVEL = 3
CHUNK = 2048
# Fixed values: (up to so many bytes, least ratio, greatest ratio).
BANDS = [
    (64, 0.45, 3.0),
    (128, 0.70, 3.5),
    (256, 0.90, 4.0),
    (512, 1.05, 4.5),
    (1024, 1.15, 5.0),
    (2048, 1.25, 5.5),
    (8192, 1.35, 6.5),
    (32768, 1.45, 8.0),
    (131072, 1.50, 10.0),
    (None, 1.50, 12.0),
]
# Share of a text's bytes that may lie in chunks outside their band.
BAD_SHARE = 0.3
SYMBOLS = "[#*$%&|<>]"


def band(n_bytes: int) -> tuple[float, float]:
    for top, low, high in BANDS:
        if top is None or n_bytes <= top:
            return low, high
    raise AssertionError("the last band is open")


def ratio(compressor: zstandard.ZstdCompressor, data: bytes) -> float:
    return len(data) / len(compressor.compress(data)) if data else 0.0


def band_verdict(compressor: zstandard.ZstdCompressor, data: bytes) -> tuple[float, float, bool]:
    """Ratio of the whole, share of bytes in chunks outside their band, and
    whether both pass. The last chunk takes the rest, half a chunk to one and
    a half. An empty text has ratio 0 and fails."""
    if not data:
        return 0.0, 0.0, False
    whole = ratio(compressor, data)
    low, high = band(len(data))
    ok = low <= whole <= high
    if len(data) <= CHUNK * 3 // 2:
        return whole, 0.0 if ok else 1.0, ok
    cuts = list(range(0, len(data), CHUNK))
    if len(data) - cuts[-1] < CHUNK // 2:
        cuts.pop()
    bad = 0
    for start, end in zip(cuts, [*cuts[1:], len(data)]):
        low, high = band(end - start)
        if not low <= ratio(compressor, data[start:end]) <= high:
            bad += end - start
    share = bad / len(data)
    return whole, share, ok and share <= BAD_SHARE


def flat_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row number of every word, and the words (runs of characters other than
    ASCII white space)."""
    lists = pc.ascii_split_whitespace(texts)
    rows, words = pc.list_parent_indices(lists), lists.flatten()
    real = pc.not_equal(words, "")
    return rows.filter(real).to_numpy(), words.filter(real)


def repeated_words(ids: np.ndarray) -> int:
    """Words of one text that lie in a 3-word window found twice or more."""
    if len(ids) < 4:
        return 0
    # A window's three word numbers fit one integer; beyond 2^20 distinct words
    # in a batch the text's own words are numbered anew.
    n = int(ids.max()) + 1
    if n > 1 << 20:
        ids = np.unique(ids, return_inverse=True)[1]
        n = int(ids.max()) + 1
    windows = ids[:-2] * n + ids[1:-1]
    if n > 1 << 20:
        windows = np.unique(windows, return_inverse=True)[1]
    windows = windows * n + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    at = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts of a batch of non-null texts."""
    n = len(texts)
    rows, words = flat_words(texts)
    n_words = np.bincount(rows, minlength=n)
    chars = np.bincount(rows, weights=pc.utf8_length(words).to_numpy(), minlength=n).astype(np.int64)
    symbols = pc.count_substring_regex(texts, SYMBOLS).to_numpy()
    lines = pc.split_pattern(texts, "\n")
    line_rows, line_text = pc.list_parent_indices(lines).to_numpy(), lines.flatten()
    real = pc.not_equal(pc.ascii_trim_whitespace(line_text), "").to_numpy(zero_copy_only=False)
    line_ids = line_text.dictionary_encode().indices.to_numpy()
    keys = (line_rows.astype(np.int64) * (len(line_text) + 1) + line_ids)[real]
    distinct = np.unique(keys) // (len(line_text) + 1)
    dup_lines = np.bincount(line_rows[real], minlength=n) - np.bincount(distinct, minlength=n)
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    ends = np.cumsum(n_words)
    repeats = np.zeros(n, dtype=np.int64)
    for i in np.flatnonzero(n_words > 3):
        repeats[i] = repeated_words(ids[ends[i] - n_words[i]:ends[i]])
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": repeats}


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, ratio double, bad_share double")


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        base = base_counts(texts)
        verdicts = [band_verdict(compressor, t.as_buffer().to_pybytes()) for t in texts.cast(pa.binary())]
        failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
        whole, share, ok = (np.array(x) for x in zip(*verdicts)) if verdicts else ([], [], np.zeros(0, bool))
        arrays = [batch.column(0), *[pa.array(v, pa.int64()) for v in base.values()], pa.array(failed, pa.bool_()),
                  pa.array(~failed & np.asarray(ok, dtype=bool), pa.bool_()), pa.array(whole, pa.float64()),
                  pa.array(share, pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, names=[
            "doc_id", *base, "base_failed", "kept", "ratio", "bad_share"])


def score_quality(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``base_failed``,
    ``kept``, the whole text's ``ratio`` and the ``bad_share`` of its chunks.

    A null text counts as empty: no words, ratio 0, base failed. Repeated rows
    are scored alike; a null doc_id stays null; an empty table gives an empty
    result; other columns are not read.
    """
    bound_arrow_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_score, SCHEMA)
