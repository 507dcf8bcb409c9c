"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; the decision after the bits ``z`` of a byte
in a context of up to ``DEPTH`` preceding bytes is a node with its counts of
zeros and ones over all training texts and their Krichevsky-Trofimov (KT)
probability. Each node's weighted probability is half its own KT probability
and half the product of its longer contexts' weighted ones, so all depths (all
trees) are mixed by how well they code the corpus. The frozen mixture then
gives every byte a probability, and a text a code length.

Distribution. The corpus is cut into chunks of about ``CHUNK_BYTES``. A chunk
reports each distinct (context, byte) and each distinct word once, with its
training count, packed by the part of the key space they belong to: the pair
of last bytes of a context, a range of word hashes. What is shuffled follows
the corpus but not its hot keys. The reports of a pair are merged in levels of
at most ``FAN_IN`` chunks, and its subtree is built from the leaves up; only the
256 contexts of one byte (at most 65,280 nodes) pass through the driver. Prices
travel back to the chunks that asked for them, so no model is broadcast and no
task holds more than a chunk with its own contexts and words.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import Staging, bound_arrow_batches, text_of

DEPTH = 5
CHUNK_BYTES = 12 << 20
FAN_IN = 64
SLICE = 2 << 20  # bytes of text whose contexts are in memory at a time
START, END = 0xFE, 0xFF  # bytes that UTF-8 text never holds
GRAM, WORD, TEXT = 0, 1, 2  # kinds of counted keys; TEXT: the end of a text

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# -- tree ---------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, stepped back."""
    y = x + 8.0
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) \
        + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    for k in range(8):
        out = out - np.log(x + k)
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log KT probability of a sequence with these counts."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - math.log(math.pi) - log_gamma(n0 + n1 + 1.0)


def bits_of(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight (node, bit) of each byte: node is 1 followed by the bits
    before."""
    steps = np.arange(7, -1, -1)
    return ((symbols[:, None] | 256) >> (steps + 1)).astype(np.int64), ((symbols[:, None] >> steps) & 1).astype(np.int64)


HALF = math.log(0.5)


class Subtree:
    """Nodes of depth 2 and more above one pair of last bytes, from its
    (context, byte) rows. ``grams`` hold the oldest byte highest and the coded
    byte lowest; ``counts`` may be 0."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int):
        self.depth = depth
        symbol = (grams & 255).astype(np.int64)
        self.z, self.bit = bits_of(symbol)
        n = np.repeat(counts.astype(float), 8)
        bit = self.bit.ravel()
        self.node, self.kt1, self.stop, self.log_w = {}, {}, {}, {}
        self.counts = {}
        below = None
        for d in range(depth, 1, -1):
            # The context of d bytes: the lowest d bytes above the symbol.
            context = (grams >> 8) & ((1 << (8 * d)) - 1)
            ids = np.unique(context, return_inverse=True)[1].astype(np.int64)
            keys = (ids[:, None] * 256 + self.z).ravel()
            _, first, node = np.unique(keys, return_index=True, return_inverse=True)
            n0 = np.bincount(node, weights=n * (bit == 0))
            n1 = np.bincount(node, weights=n * (bit == 1))
            own = log_kt(n0, n1)
            if d == depth:
                weighted, stop = own, np.ones_like(own)
            else:
                deeper_node, deeper_first, deeper_w = below
                children = np.bincount(node[deeper_first], weights=deeper_w, minlength=len(own))
                weighted = np.logaddexp(HALF + own, HALF + children)
                stop = np.exp(HALF + own - weighted)
            self.node[d], self.kt1[d], self.stop[d] = node, (n1 + 0.5) / (n0 + n1 + 1.0), stop
            self.log_w[d], self.counts[d] = weighted, (n0, n1)
            below = (node, first, weighted)
        self.top = below[1]  # one row of each node of depth 2

    def summary(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes of depth 2: z, zeros, ones, log weighted probability."""
        n0, n1 = self.counts[2]
        return self.z.ravel()[self.top], n0, n1, self.log_w[2]

    def log_prices(self, mass: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Log probability of every row's byte. ``mass[z]`` is the weight that
        depths 0 and 1 pass on, ``one[z]`` what they say of a one bit."""
        z = self.z.ravel()
        left, p1 = mass[z].copy(), one[z].copy()
        for d in range(2, self.depth + 1):
            stop, kt1 = self.stop[d][self.node[d]], self.kt1[d][self.node[d]]
            p1 += left * stop * kt1
            left *= 1 - stop
        return np.log(np.where(self.bit.ravel() == 1, p1, 1 - p1)).reshape(-1, 8).sum(1)


class Trunk:
    """Depths 0 and 1, from the summaries of depth 2 summed over the older
    byte: arrays by (last byte, z)."""

    def __init__(self, n0: np.ndarray, n1: np.ndarray, children: np.ndarray):
        own1 = log_kt(n0, n1)
        w1 = np.logaddexp(HALF + own1, HALF + children)
        own0 = log_kt(n0.sum(0), n1.sum(0))
        w0 = np.logaddexp(HALF + own0, HALF + w1.sum(0))
        stop0, stop1 = np.exp(HALF + own0 - w0), np.exp(HALF + own1 - w1)
        kt0 = (n1.sum(0) + 0.5) / (n0.sum(0) + n1.sum(0) + 1.0)
        kt1 = (n1 + 0.5) / (n0 + n1 + 1.0)
        self.mass = (1 - stop0) * (1 - stop1)
        self.one = stop0 * kt0 + (1 - stop0) * stop1 * kt1


# -- chunks -------------------------------------------------------------------

def coded_bytes(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The (context, byte) numbers of all texts, and how many each text has:
    its bytes and one end. A text begins in a context of start bytes."""
    data = [x.as_buffer() for x in texts.cast(pa.large_binary())]
    sizes = np.array([b.size + 1 for b in data], dtype=np.int64)
    flat = np.full(int(sizes.sum()) + depth * len(data), START, np.uint8)
    # Each text behind its own start bytes; places[i] is its first byte.
    places = np.cumsum(sizes + depth) - sizes
    for at, b in zip(places, data):
        flat[at:at + b.size] = np.frombuffer(b, np.uint8)
        flat[at + b.size] = END
    grams = np.zeros(max(0, len(flat) - depth), np.int64)
    for k in range(depth + 1):
        grams = (grams << 8) | flat[k:len(flat) - depth + k]
    # Windows that end in start bytes belong to no text.
    return grams[flat[depth:] != START], sizes


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each text, index of every word, hashes of the
    distinct ones."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    lower = pa.py_buffer(data.to_pybytes().translate(_LOWER)) if data is not None else None
    lists = pc.ascii_split_whitespace(
        pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, lower], offset=texts.offset))
    rows, words = pc.list_parent_indices(lists), lists.flatten()
    real = pc.not_equal(words, "")
    coded = words.filter(real).dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()],
                      dtype=np.uint64).view(np.int64)
    return np.bincount(rows.filter(real).to_numpy(), minlength=len(texts)), coded.indices.to_numpy(), hashes


def pack(values: np.ndarray) -> bytes:
    """Sorted keys as differences, or numbers as they are: byte planes,
    compressed. The type goes first."""
    kind = {"i": b"i", "f": b"f"}[values.dtype.kind]
    flat = np.diff(values, prepend=0) if kind == b"i" else values.astype(np.float32).view(np.int32)
    width = flat.dtype.itemsize
    return kind + zstandard.compress(np.ascontiguousarray(flat).view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob[1:]), np.uint8)
    width = 8 if blob[:1] == b"i" else 4
    flat = np.ascontiguousarray(raw.reshape(width, -1).T).ravel()
    return np.cumsum(flat.view(np.int64)) if width == 8 else flat.view(np.float32).astype(float)


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
    return distinct, np.bincount(at, weights=np.concatenate([np.zeros(0), *counts]), minlength=len(distinct)).astype(np.int64)


def tally(grams: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``merge`` of one array whose counts are 0 or 1: the count goes in the
    lowest bit, so that a plain sort does. Grams have at most 56 bits."""
    marked = np.sort((grams << 1) | train)
    keys = marked >> 1
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(marked & 1, first) if len(first) else first


def slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE`` bytes."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > SLICE:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def text_sizes(texts: pa.Array) -> np.ndarray:
    return pc.binary_length(texts).to_numpy().astype(np.int64)


def gram_part(keys: np.ndarray) -> np.ndarray:
    return (keys >> 8) & 0xFFFF


def word_part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys.view(np.uint64) % np.uint64(parts)).astype(np.int64)


ASKED = "chunk long, kind int, part long, keys binary, counts binary"
ASKED_NAMES = ["chunk", "kind", "part", "keys", "counts"]


def _chunk_keys(depth: int, parts: int):
    """Rows of chunk, train, text to the packed distinct keys of each chunk
    seen in one run of rows, with their training counts."""
    def reports(chunk: int, held: list) -> pa.RecordBatch:
        rows = []
        for kind in (GRAM, WORD):
            keys, counts = merge([h[kind][0] for h in held], [h[kind][1] for h in held])
            part = gram_part(keys) if kind == GRAM else word_part(keys, parts)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                at = order[a:b]
                rows.append((kind, int(part[at[0]]), pack(keys[at]), pack(np.cumsum(counts[at]))))
        rows.append((TEXT, sum(h[TEXT] for h in held), b"", b""))  # their number stands for the part
        kind, part, keys, counts = zip(*rows)
        return pa.RecordBatch.from_arrays([
            pa.array([chunk] * len(rows), pa.int64()), pa.array(kind, pa.int32()), pa.array(part, pa.int64()),
            pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=ASKED_NAMES)

    def count(batch: pa.RecordBatch) -> list:
        train, texts = batch.column(1).to_numpy().astype(float), batch.column(2)
        found = []
        for a, b in slices(text_sizes(texts)):
            grams, sizes = coded_bytes(texts.slice(a, b - a), depth)
            found.append(tally(grams, np.repeat(train[a:b].astype(np.int64), sizes)))
        counts, at, hashes = words_of(texts)
        return [merge(*map(list, zip(*found))), merge([hashes[at] if len(at) else hashes], [np.repeat(train, counts)]),
                int(train.sum())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        current = None
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(chunks)) + 1, [len(chunks)]]) if len(chunks) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if current is not None and chunks[a] != current:
                    yield reports(current, held)
                    held = []
                current = int(chunks[a])
                held.append(count(batch.slice(a, b - a)))
                if len(held) > 3:  # keep what a chunk holds merged
                    held = [[merge([h[k][0] for h in held], [h[k][1] for h in held]) for k in (GRAM, WORD)]
                            + [sum(h[TEXT] for h in held)]]
        if held:
            yield reports(current, held)
    return run


def _unpacked(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return ([unpack(k) for k in table["keys"].to_pylist()],
            [np.diff(unpack(c), prepend=0) for c in table["counts"].to_pylist()])


def _merge_group(table: pa.Table) -> pa.Table:
    """The reports of one pair (and group of chunks) as one."""
    keys, counts = merge(*_unpacked(table))
    return pa.table({"part": table["part"].slice(0, 1), "keys": pa.array([pack(keys)], pa.binary()),
                     "counts": pa.array([pack(np.cumsum(counts))], pa.binary())})


ANSWER = "chunk long, kind int, keys binary, prices binary"
TOTALS = ", n long, v long"


def _answer_words(table: pa.Table) -> pa.Table:
    """The reports of one range of word hashes: to every chunk the total
    counts of the words it reported, and to chunk null the number of training
    tokens and of distinct ones among them."""
    keys, counts = _unpacked(table)
    own, total = merge(keys, counts)
    prices = [pack(total[np.searchsorted(own, k)].astype(np.float64)) for k in keys]
    return pa.table({
        "chunk": pa.array([*table["chunk"].to_pylist(), None], pa.int64()),
        "kind": pa.array([WORD] * (len(keys) + 1), pa.int32()),
        "keys": pa.array([*table["keys"].to_pylist(), None], pa.binary()),
        "prices": pa.array([*prices, None], pa.binary()),
        "n": pa.array([None] * len(keys) + [int(total.sum())], pa.int64()),
        "v": pa.array([None] * len(keys) + [int((total > 0).sum())], pa.int64())})


def _answer_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """chunk, keys, all_keys, all_prices to the chunk's prices."""
    for batch in batches:
        prices = []
        for keys, every, price in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            prices.append(pack(unpack(price)[np.searchsorted(unpack(every), unpack(keys))]))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([GRAM] * len(prices), pa.int32()), batch.column(1),
            pa.array(prices, pa.binary())], names=["chunk", "kind", "keys", "prices"])


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, wanted)
    assert len(wanted) == 0 or (keys[np.minimum(at, len(keys) - 1)] == wanted).all(), "a key without an answer"
    return values[at]


def _score_chunk(depth: int, n_train: int, n_distinct: int, n_texts: int):
    log10_e = math.log10(math.e)
    scale = math.log10(n_train + 0.1 * (n_distinct + 1))

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return SCORED.empty_table()
        docs = docs.combine_chunks()
        texts = docs["text"].chunk(0)
        known = {}
        for kind in (GRAM, WORD):
            own = answers.filter(pc.equal(answers["kind"], kind))
            keys = np.concatenate([np.zeros(0, np.int64), *(unpack(k) for k in own["keys"].to_pylist())])
            prices = np.concatenate([np.zeros(0), *(unpack(p) for p in own["prices"].to_pylist())])
            order = np.argsort(keys)
            known[kind] = keys[order], prices[order]
        score, all_sizes = [], []
        for a, b in slices(text_sizes(texts)):
            grams, sizes = coded_bytes(texts.slice(a, b - a), depth)
            own, at = np.unique(grams, return_inverse=True)
            price = _lookup(*known[GRAM], own)
            score.append(np.add.reduceat(price[at], np.cumsum(sizes) - sizes) * log10_e)
            all_sizes.append(sizes)
        score, sizes = np.concatenate(score), np.concatenate(all_sizes)
        counts, at, hashes = words_of(texts)
        c = np.rint(_lookup(*known[WORD], hashes))
        row = np.repeat(np.arange(len(texts)), counts)
        base = np.bincount(row, weights=(np.log10(c + 0.1) - scale)[at] if len(at) else None, minlength=len(texts)) \
            + (math.log10(n_texts + 0.1) - scale)
        seen = np.bincount(row, weights=(c > 0)[at] if len(at) else None, minlength=len(texts)) + (n_texts > 0)
        return pa.table({
            "doc_id": docs["doc_id"], "held_out": pc.equal(docs["train"], 0),
            "n_tokens": pa.array(counts + 1, pa.int64()), "n_known": pa.array(seen.astype(np.int64)),
            "train_tokens": pa.array(np.full(len(texts), n_train, np.int64)),
            "base_score": pa.array(base), "score": pa.array(score),
            "bits_per_byte": pa.array(-score / math.log10(2) / sizes)})
    return run


SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                    ("bits_per_byte", pa.float64())])


def _summaries(depth: int):
    """Per pair: its nodes of depth 2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                z, n0, n1, w = Subtree(unpack(keys), np.diff(unpack(counts), prepend=0), depth).summary()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(z), part & 255, np.int32)),
                                                  pa.array(z.astype(np.int32)), n0, n1, w],
                                                 names=["last", "z", "n0", "n1", "w"])
    return run


def _prices(depth: int, mass: np.ndarray, one: np.ndarray):
    """Per pair: the log probability of each byte in each context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prices = []
            for part, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                tree = Subtree(unpack(keys), np.diff(unpack(counts), prepend=0), depth)
                prices.append(pack(tree.log_prices(mass[part & 255], one[part & 255])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prices, pa.binary())],
                                             names=["part", "all_keys", "all_prices"])
    return run


def chunked_rows(docs: DataFrame, staging: Staging, folds: int) -> tuple[DataFrame, int]:
    """doc_id, text, train, chunk, and the number of chunks. A chunk is a run
    of rows of one file, so every scan finds the same chunks, whatever its
    splits; rows that come from no file are staged first."""
    train = F.coalesce((F.crc32(F.col("doc_id").cast("string")) % folds != 0).cast("int"), F.lit(0))
    columns = [F.col("doc_id").cast("long"), text_of("text").cast("string").alias("text"), train.alias("train")]
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        rows = docs.select(*columns, *place)
    except AnalysisException:
        rows = staging.write(docs.select(*columns), "rows").select("*", *place)
    n, total = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    per = max(1, int(CHUNK_BYTES * n / max(1, total or 0))) if n else 1
    chunk = F.xxhash64("file").bitwiseAND(~0xFFFFF) + F.floor(F.col("row") / per)
    return rows.select("doc_id", "text", "train", chunk.alias("chunk")), -(-int(total or 0) // CHUNK_BYTES) + 1


def score_texts(docs: DataFrame, depth: int = DEPTH, folds: int = 10, staging: Staging | None = None) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, bits_per_byte``.

    Documents whose crc32(doc_id as text) mod ``folds`` is not 0 train the
    model; ``held_out`` marks the others. ``score`` is log10 of the model's
    probability of the text's bytes and its end, ``bits_per_byte`` the code
    length over that number of bytes. ``base_score`` is the sum over tokens
    (A-Z lower-cased words, then an end) of log10((c + 0.1) / (N + 0.1 (V +
    1))), ``n_known`` the tokens with c > 0, ``train_tokens`` N. A null text is
    empty: one token, the end. A null doc_id is held out. Repeated rows train
    and are scored each. ``depth`` is 2 to 6.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    staging = staging or Staging(spark, "ctw")
    rows, n_chunks = chunked_rows(docs, staging, folds)
    # A range of word hashes gets about an eighth of a chunk's words over all
    # chunks, however many those are.
    asked = staging.write(rows.select("chunk", "train", "text").mapInArrow(
        _chunk_keys(depth, 8 * n_chunks), ASKED), "asked")

    grams = asked.filter(F.col("kind") == GRAM).select("part", F.xxhash64("chunk").alias("salt"), "keys", "counts")
    n = n_chunks
    while n > FAN_IN:  # pre-merge, so that no group grows with the corpus
        n = -(-n // FAN_IN)
        grams = grams.withColumn("salt", F.pmod("salt", F.lit(n)))
        merged = grams.groupBy("part", "salt").applyInArrow(_merge_group, "part long, keys binary, counts binary")
        grams = staging.write(merged.withColumn("salt", F.xxhash64("keys")), f"merged-{n}")
    grams = staging.write(grams.select("part", "keys", "counts").groupBy("part").applyInArrow(
        _merge_group, "part long, keys binary, counts binary"), "grams")
    words = staging.write(asked.filter(F.col("kind") == WORD).groupBy("part").applyInArrow(
        _answer_words, ANSWER + TOTALS), "words")

    n_words, v_words = (int(x or 0) for x in words.agg(F.sum("n"), F.sum("v")).first())
    n_texts = int(asked.filter(F.col("kind") == TEXT).agg(F.sum("part")).first()[0] or 0)
    tops = (grams.mapInArrow(_summaries(depth), "last int, z int, n0 double, n1 double, w double")
            .groupBy("last", "z").agg(F.sum("n0"), F.sum("n1"), F.sum("w")).collect())
    n0, n1, w = (np.zeros((256, 256)) for _ in range(3))
    for last, z, *values in tops:
        n0[last, z], n1[last, z], w[last, z] = values
    trunk = Trunk(n0, n1, w)
    price = staging.write(grams.mapInArrow(_prices(depth, trunk.mass, trunk.one),
                                           "part long, all_keys binary, all_prices binary"), "price")
    priced = (asked.filter(F.col("kind") == GRAM).select("part", "chunk", "keys").join(price, "part")
              .select("chunk", "keys", "all_keys", "all_prices").mapInArrow(_answer_grams, ANSWER))
    answers = priced.unionAll(words.filter("chunk IS NOT NULL").drop("n", "v"))
    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double, bits_per_byte double")
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score_chunk(depth, n_words + n_texts, v_words + (n_texts > 0), n_texts), schema)
