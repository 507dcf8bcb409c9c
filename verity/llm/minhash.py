"""MinHash near-duplicates by a signature-coordinate inverted join.

Every document posts itself under its ``COORDINATES`` (coordinate, value)
pairs. Two documents are candidates when at least ``MATCHES`` postings
coincide; at a similarity of exactly 0.75 the chance to miss that, or the
finer test before the sets are read, is below 1e-7.
Counting collisions over all posting lists would merge very long ones, so:

* documents with the same shingle set are one class and post once;
* a pair only one class holds cannot collide and is dropped;
* each class orders what is left by global frequency, rarest first. Two
  classes with ``MATCHES`` collisions share one of the first
  ``held - MATCHES + 1`` (prefix), so only those short lists are merged;
* the long lists behind the prefix are skipped, not merged: whether a candidate
  is in them is looked up in its signature (skip).

A list of n near copies is not expanded to n^2 pairs; every round gives at
most as many rows as its lists have members:

1. Every class is compared with one hub, the most connected member of its
   lists, and what links is joined to components.
2. Members of one list that are still in different components meet in blocks
   spread over tasks. A block reports a spanning forest of its candidates,
   likeliest first, whose pairs are confirmed on the full sets.
3. Where such a pair fails, other candidates of the block might still join its
   sides: all members of that tree, which are those with a candidate in it,
   meet once more with their sets. Every candidate between components that are
   still apart is tested, and a spanning forest of the links reported.

A tree whose pairs are confirmed has nothing left to join, so the components
are those of the full link graph. Jaccard distance is a metric and the distance
to the hub is known, so two members whose distances to one hub differ by more
than 0.25 cannot link and are passed over, as are two whose sets differ too much
in size. Each link is confirmed on the full shingle sets.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import Staging, bound_arrow_batches, releasing
from verity.llm.components import components

SHINGLE = 5
PERCENT = 75
COORDINATES = 64
MATCHES = 28
# One-byte values that tell candidates of one list apart more finely, before
# any set is read; at 0.75 fewer than FINE_MATCHES agree in below 3e-8 of pairs.
FINE = 512
FINE_MATCHES = 329
BLOCK = 1024  # members of a block
BLOCK_BYTES = 32 << 20  # bytes of a block's shingle sets

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = (np.random.default_rng(20).integers(1, 2**63, COORDINATES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each text, and the 64-bit hashes of all words; A-Z
    fold, words are runs of characters other than ASCII white space."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    lower = pa.py_buffer(data.to_pybytes().translate(_LOWER)) if data is not None else None
    lists = pc.ascii_split_whitespace(
        pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, lower], offset=texts.offset))
    rows, words = pc.list_parent_indices(lists), lists.flatten()
    real = pc.not_equal(words, "")
    coded = words.filter(real).dictionary_encode()
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()],
                   dtype=np.uint64)
    hashes = own[coded.indices.to_numpy()] if len(own) else own
    return np.bincount(rows.filter(real).to_numpy(), minlength=len(texts)), hashes


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    counts, words = word_hashes(texts)
    rolled = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * _BASE + words[k:len(words) - SHINGLE + 1 + k]
    rolled = mix(rolled)
    start = 0
    for n in counts:
        if n >= SHINGLE:
            yield np.unique(rolled[start:start + n - SHINGLE + 1])
        elif n:  # fewer words: the whole sequence, told apart by its length
            h = np.full(1, n, np.uint64)
            for w in words[start:start + n]:
                h = h * _BASE + w
            yield mix(h)
        else:
            yield np.zeros(0, np.uint64)
        start += n


_FINE = (np.random.default_rng(21).integers(1, 2**63, FINE, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def fine_signature(shingles: np.ndarray) -> bytes:
    low = np.full(FINE, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        low = np.minimum(low, (shingles[i:i + 512, None] * _FINE).min(0))
    return (mix(low) >> np.uint64(56)).astype(np.uint8).tobytes()


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[i:i + 4096, None] * _FACTORS).min(0))
    return (mix(low) >> np.uint64(32)).astype(np.uint32).view(np.int32)


SIGNED = "doc_id long, t long, n_shingles long, d1 long, d2 long, sig array<int>"


@releasing
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, d1, d2, sigs = [], [], [], []
        for s in shingle_sets(pc.fill_null(batch.column(2), "")):
            counts.append(len(s))
            d1.append(np.add.reduce(mix(s + _BASE)))
            d2.append(np.bitwise_xor.reduce(mix(s ^ np.uint64(0xD6E8FEB86659FD93))))
            sigs.append(signature(s) if len(s) else np.zeros(0, np.int32))
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sigs])])
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:2], pa.array(counts, pa.int64()),
            pa.array(np.array(d1, np.uint64).view(np.int64)), pa.array(np.array(d2, np.uint64).view(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(sigs or [[]]), pa.int32()))],
            names=["doc_id", "t", "n_shingles", "d1", "d2", "sig"])


@releasing
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep, sig, mask, text to rep, sig, mask, the fine signature and the shingle set."""
    for batch in batches:
        sets = list(shingle_sets(pc.fill_null(batch.column(3), "")))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([fine_signature(s) for s in sets], pa.binary()),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "sig", "mask", "fine", "shingles"])


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


MEASURED = "a long, b long, shared long, either long"


@releasing
def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, set_a, b, set_b to the sizes of their intersection and union."""
    for batch in batches:
        shared, either = [], []
        for x, y in zip(batch.column(1), batch.column(3)):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            shared.append(_shared(x, y))
            either.append(len(x) + len(y) - shared[-1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(shared, pa.int64()),
                                          pa.array(either, pa.int64())], names=["a", "b", "shared", "either"])


LINKED = f"100 * shared >= {PERCENT} * either"


def measure(pairs: DataFrame, suspects: DataFrame) -> DataFrame:
    """The pairs ``a, b`` on their full sets. The set of ``a``, of which there
    is about one row each, joins first, so that the second join meets a
    popular ``b`` with rows of their full size and AQE can split it."""
    def side(name: str) -> DataFrame:
        return suspects.select(F.col("rep").alias(name), F.col("shingles").alias(f"set_{name}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "set_a", "b", "set_b")
    return rows.mapInArrow(_measure, MEASURED)


class _Joined:
    """Sets of the components met in one block."""

    def __init__(self, components: np.ndarray):
        self.above = {int(c): int(c) for c in components}

    def root(self, c: int) -> int:
        while self.above[c] != c:
            self.above[c] = self.above[self.above[c]]
            c = self.above[c]
        return c

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart until now."""
        a, b = self.root(a), self.root(b)
        self.above[a] = b
        return a != b


def _candidates(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The candidates among the members of a block of one list (or, of two
    blocks ``i`` and ``j``, between side 0 and side 1) as rows x and y of the
    table, likeliest first: pairs in different components with at least
    ``MATCHES`` collisions, as many agreeing fine values, and set sizes and
    distances to a common hub that allow a link. A pair that shares several
    lists counts in the one of the first shared coordinate."""
    rep, comp, side, hub, far, mask, size = (table[c].to_numpy() for c in (
        "rep", "component", "side", "hub", "far", "mask", "n_shingles"))
    coordinate = int(table["key"][0].as_py() >> 32)
    sig = table["sig"].combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    fine = np.frombuffer(b"".join(table["fine"].to_pylist()), np.uint8).reshape(-1, FINE)
    bits = (mask.view(np.uint64)[:, None] >> np.arange(COORDINATES, dtype=np.uint64)) & np.uint64(1) == 1
    found = []
    two = table["i"][0].as_py() != table["j"][0].as_py()
    right = np.flatnonzero(side == (1 if two else 0))
    limit = (100 - PERCENT) / 100 + 1e-9
    for i in np.flatnonzero(side == 0):
        others = right[comp[right] != comp[i]]
        if not two:
            others = others[rep[others] > rep[i]]
        apart = (hub[others] == hub[i]) & (np.abs(far[others] - far[i]) > limit)
        alike = 100 * np.minimum(size[others], size[i]) >= PERCENT * np.maximum(size[others], size[i])
        others = others[~apart & alike & (hub[others] != rep[i]) & (rep[others] != hub[i])]
        same = sig[others] == sig[i]
        first = (same & bits[others] & bits[i]).argmax(1)
        hit = others[(same.sum(1) >= MATCHES) & (first == coordinate)] if len(others) else others
        agree = (fine[hit] == fine[i]).sum(1)
        enough = agree >= FINE_MATCHES
        found.append(np.stack([np.full(enough.sum(), i), hit[enough], agree[enough]]))
    x, y, agree = np.concatenate(found or [np.zeros((3, 0), np.int64)], axis=1)
    order = np.lexsort((rep[y], rep[x], -agree))
    return x[order], y[order]


# A block of a list, and a tree of its forest.
TREE = ("key", "i", "j", "tree")
CROSSING = "key long, i int, j int, tree long, a long, b long"


def _collisions(table: pa.Table) -> pa.Table:
    """The members of a block to a spanning forest ``a, b`` of its candidates,
    likeliest pairs first. Further members with a candidate have a row of their
    own, as ``a`` (side 0) or ``b`` (side 1) alone: no more rows than members."""
    rep, comp = table["rep"].to_numpy(), table["component"].to_numpy()
    x, y = _candidates(table)
    joined = _Joined(comp)
    kept = [p for p in range(len(x)) if joined.join(int(comp[x[p]]), int(comp[y[p]]))]
    x0, y0 = x[kept], y[kept]
    two = table["i"][0].as_py() != table["j"][0].as_py()
    ends = np.concatenate([x0, y0])
    lone_a = np.setdiff1d(x if two else np.concatenate([x, y]), ends)
    lone_b = np.setdiff1d(y, ends) if two else lone_a[:0]
    a = [*rep[x0].tolist(), *rep[lone_a].tolist(), *[None] * len(lone_b)]
    b = [*rep[y0].tolist(), *[None] * len(lone_a), *rep[lone_b].tolist()]
    tree = [joined.root(int(c)) for c in comp[np.concatenate([x0, lone_a, lone_b]).astype(np.int64)]]
    place = [pa.array(np.full(len(a), table[c][0].as_py()), t)
             for c, t in (("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()))]
    return pa.table([*place, *(pa.array(v, pa.int64()) for v in (tree, a, b))], names=[*TREE, "a", "b"])


def _confirm(table: pa.Table, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> pa.Table:
    """Members, with their sets, to a spanning forest of the links between
    different components among ``pairs`` (rows of the table; default: all)."""
    rep, comp = table["rep"].to_numpy(), table["component"].to_numpy()
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table["shingles"].combine_chunks()]
    joined = _Joined(comp)
    out = []
    for i, j in zip(*(np.triu_indices(len(rep), 1) if pairs is None else pairs)):
        if joined.root(int(comp[i])) == joined.root(int(comp[j])):
            continue
        shared = _shared(sets[i], sets[j])
        if 100 * shared >= PERCENT * (len(sets[i]) + len(sets[j]) - shared):
            joined.join(int(comp[i]), int(comp[j]))
            out.append((rep[i], rep[j]))
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def _meet_again(table: pa.Table) -> pa.Table:
    """The members of a tree to the links of its candidates."""
    return _confirm(table, _candidates(table))


def cross_pairs(lists: DataFrame, labels: DataFrame, members: DataFrame, staging: Staging) -> DataFrame:
    """Forests of candidate pairs (``CROSSING``) of the lists that still hold
    several components. ``members``: rep, n_shingles, sig, fine, hub, far
    (distance to the hub), mask (coordinates of the prefix)."""
    named = staging.write(lists.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
                          .withColumn("component", F.coalesce("component", "rep"))
                          .select("key", "rep", "component", "n_shingles"), "named")
    mixed = (named.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"),
                                      F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
             .select("key", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") * 8 / BLOCK_BYTES))
                     .cast("int").alias("blocks")))
    rows = (named.drop("n_shingles").join(mixed, "key").join(members, "rep")
            .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    # A member of block i meets the blocks j >= i as side 0 and the blocks
    # j <= i as side 1; inside its own block it is side 0 only.
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j"),
        F.when(j < F.col("own"), 1).otherwise(0).alias("side")))
    met = rows.withColumn("m", F.explode(meets)).select(
        "key", F.col("m.i").alias("i"), F.col("m.j").alias("j"), F.col("m.side").alias("side"), "rep", "component",
        "n_shingles", "sig", "fine", "hub", "far", "mask")
    return staging.write(met.groupBy("key", "i", "j").applyInArrow(_collisions, CROSSING), "crossing")


def cross_links(crossing: DataFrame, labels: DataFrame, suspects: DataFrame, staging: Staging) -> DataFrame:
    """Links ``a, b`` that join the components which the candidates of
    ``crossing`` can join: the confirmed pairs of the forests, and the links
    found among all members of a tree in which a pair failed."""
    forests = crossing.filter("a IS NOT NULL AND b IS NOT NULL")
    tested = staging.write(measure(forests.select("a", "b").distinct(), suspects), "measured-cross")
    first = tested.filter(LINKED).select("a", "b")
    known = components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(first),
                       staging, "cross").withColumnRenamed("id", "rep")
    failed = forests.join(tested.filter(f"NOT ({LINKED})").select("a", "b"), ["a", "b"]).select(*TREE).distinct()
    ends = F.array(F.struct(F.col("a").alias("rep"), F.lit(0).alias("side")),
                   F.struct(F.col("b").alias("rep"), F.expr("int(i <> j)").alias("side")))
    again = (crossing.join(failed, list(TREE)).select(*TREE, F.inline(ends)).filter("rep IS NOT NULL").distinct()
             .join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    again = staging.write(again, "again")
    # Other lists' links may have joined a tree meanwhile.
    apart = (again.groupBy(*TREE).agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter("lo <> hi").select(*TREE))
    met = again.join(apart, list(TREE)).join(suspects.select(
        "rep", "sig", "mask", "fine", "shingles", (F.length("shingles") / 8).cast("long").alias("n_shingles"),
        F.col("rep").alias("hub"), F.lit(0.0).alias("far")), "rep")  # hubs have ruled out what they could
    second = met.groupBy(*TREE).applyInArrow(_meet_again, "a long, b long")
    return staging.write(first.unionAll(second), "links-cross")


def near_duplicates(docs: DataFrame, staging: Staging | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Words are lower-cased (A-Z) runs of characters other than ASCII white
    space; a document's set holds its distinct 5-word shingles, or its whole
    word sequence when it has fewer words. A text that is null, empty or
    without words has an empty set and links with nothing. Documents link when
    100 * intersection >= 75 * union; ``component_id`` is the smallest doc_id
    reachable and the one that is ``kept``. Rows that share a doc_id each give
    a row; equal ones share their component, different texts under one id have
    their own. A null doc_id links with nothing and is its own (null)
    component, kept. Texts are read whole at any length; an empty table gives
    no rows; other columns are not read, whatever their names. Shingles are
    compared by 64-bit hashes, sets for equality by a 128-bit digest.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    staging = staging or Staging(spark, "minhash")
    # t tells rows apart that share a doc_id.
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("t"), text.alias("text"))
    signed = staging.write(rows.mapInArrow(_sign, SIGNED), "signed")
    # A class is a set; its number is settled by the write, its label is the
    # smallest doc_id.
    classes = (signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n_shingles")
               .agg(F.min(F.struct("doc_id", "t")).alias("first"), F.first("sig").alias("sig"))
               .select("d1", "d2", "n_shingles", "first", "sig", F.monotonically_increasing_id().alias("rep")))
    classes = staging.write(classes, "classes")

    posted = classes.select("rep", "n_shingles", F.posexplode("sig").alias("k", "v")).select(
        "rep", "n_shingles",
        (F.shiftleft(F.col("k").cast("long"), 32) + F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)).alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    held = (posted.join(shared, "key").groupBy("rep")
            .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"), F.sum("n").alias("score"),
                 F.first("n_shingles").alias("n_shingles"))
            .filter(F.size("keys") >= MATCHES)
            .select("rep", "n_shingles", "score", F.slice("keys", 1, F.size("keys") - MATCHES + 1).alias("prefix"))
            .withColumn("mask", F.expr("aggregate(prefix, 0L, (m, p) -> m | shiftleft(1L, int(shiftright(p.key, 32))))")))
    held = staging.write(held, "held")
    lists = staging.write(held.select("rep", "n_shingles", "score", F.explode("prefix").alias("p"))
                          .select(F.col("p.key").alias("key"), "rep", "n_shingles", "score"), "lists")
    asked = (held.select("rep", "mask").join(classes.select("rep", "sig", "first"), "rep")
             .select("rep", "sig", "mask", F.col("first.doc_id").alias("doc_id"), F.col("first.t").alias("t")))
    suspects = (asked.join(rows, ["doc_id", "t"]).select("rep", "sig", "mask", "text").mapInArrow(
        _sets, "rep long, sig array<int>, mask long, fine binary, shingles binary").dropDuplicates(["rep"]))
    suspects = staging.write(suspects, "suspects")

    hub = lists.groupBy("key").agg(F.max(F.struct("score", (-F.col("rep")).alias("m"))).alias("hub"))
    star = (lists.select("key", "rep").join(hub, "key").filter(F.col("rep") != -F.col("hub.m"))
            .groupBy(F.col("rep").alias("a")).agg(F.max("hub").alias("hub"))
            .select("a", (-F.col("hub.m")).alias("b")))
    measured = staging.write(measure(star, suspects), "measured-star")
    labels = components(measured.filter(LINKED), staging, "first")
    near_hub = measured.select(F.col("a").alias("rep"), F.col("b").alias("hub"),
                               (1 - F.col("shared") / F.col("either")).alias("far"))
    members = staging.write(
        suspects.select("rep", (F.length("shingles") / 8).cast("long").alias("n_shingles"), "sig", "fine", "mask")
        .join(near_hub, "rep", "left")
        .select("rep", "n_shingles", "sig", "fine", F.coalesce("hub", "rep").alias("hub"), F.coalesce("far", F.lit(0.0)).alias("far"), "mask"),
        "members")
    crossing = cross_pairs(lists.select("key", "rep", "n_shingles"), labels, members, staging)
    second = cross_links(crossing, labels, suspects, staging)
    staging.drop("suspects", "named", "held", "lists", "members", "crossing", "measured-cross", "again")
    # Both rounds' links; those between old components are enough, as the
    # first round's labels stand for its links.
    links = labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(second)
    final = components(links, staging, "final").withColumnRenamed("id", "rep")
    joined = (classes.select("d1", "d2", "n_shingles", "rep", F.col("first.doc_id").alias("label"))
              .join(final, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    smallest = joined.groupBy("component").agg(F.min("label").alias("least"))
    named = (joined.join(smallest, "component")
             .select("d1", "d2", "n_shingles", F.col("least").alias("component")))
    return (signed.drop("sig", "t").join(named, ["d1", "d2", "n_shingles"], "left")
            .withColumn("component_id", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), "doc_id"))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the
    smallest doc_id (null last), then text.

    Rows are told apart by a number of their own, not by doc_id: of equal
    rows one stays, near copies without an id are copies like others, and
    different texts that share an id are different documents. Rows without
    words all stay. The columns are those of ``docs``, whatever their names;
    an empty table stays empty.
    """
    staging = Staging(docs.sparkSession, "near-dedup")
    # The write settles the numbers.
    rows = staging.write(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                                     F.monotonically_increasing_id().alias("row")), "rows")
    near = near_duplicates(rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), staging)
    grouped = near.select(F.col("doc_id").alias("row"), "component_id")
    several = grouped.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
    copies = staging.write(
        grouped.join(several, "component_id")
        .join(rows.select("row", F.col("doc.doc_id").alias("id"), F.md5("doc.text").alias("digest")), "row")
        .select("component_id", F.struct(F.col("id").isNull(), "id", "digest", "row").alias("place")), "copies")
    first = copies.groupBy("component_id").agg(F.min("place").alias("first"))
    losers = (copies.join(first, "component_id").filter("place.row <> first.row")
              .select(F.col("place.row").alias("row")))
    return rows.join(losers, "row", "left_anti").select("doc.*")
