"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Fitting uses a bounded sample of labelled rows (``EXAMPLES`` per class, chosen
by a hash of the id, near copies of one another thinned out): the sample gives
the terms worth an index (those whose presence depends on the label far beyond
chance) and the example vectors. Document frequencies cover all documents.

Scoring finds, for every document, the ``K`` examples of largest cosine. The
index is inverted and split into blocks of examples; it keeps the largest
weight of each term in each block. The sum of a query's weights times those
maxima bounds every cosine in the block, so blocks are opened in the order of
their bound until no bound reaches the K-th best cosine: the result is exact.
Neighbours vote with weight 1 / (distance + ``SOFT``), times how many labelled
rows an example stands for; a logistic curve fitted on the examples' own
leave-one-out votes turns the vote into a probability. The neighbours are
returned as evidence.

The index is bounded by ``2 * EXAMPLES`` examples of at most ``FEATURES``
terms, so it travels with the task; documents are never shuffled.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verity.llm.common import Staging, bound_arrow_batches, releasing

EXAMPLES = 2000  # per class
CHI2 = 20.0  # least chi-square of a term, p about 1e-5
FEATURES = 1024
STEMS = (4, 5)  # first letters of longer words, as terms of their own
K = 15
SOFT = 0.1
BLOCK = 64

# A word is a run of letters, digits and characters beyond ASCII; A-Z fold.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def folded(texts: pa.Array) -> pa.Array:
    """Lower-cased ASCII letters, every separator a space; byte lengths stay,
    so the offsets do too."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    moved = pa.py_buffer(data.to_pybytes().translate(_FOLD)) if data is not None else None
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, moved], offset=texts.offset)


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and word number of every word of a batch, and the distinct words."""
    lists = pc.ascii_split_whitespace(folded(texts))
    rows, words = pc.list_parent_indices(lists), lists.flatten()
    real = pc.not_equal(words, "")
    coded = words.filter(real).dictionary_encode()
    return rows.filter(real).to_numpy(), coded.indices.to_numpy(), coded.dictionary


def _stems(words: pa.Array, letters: int) -> pa.Array:
    """``word*`` for the first letters of longer words, else null."""
    long = pc.greater(pc.utf8_length(words), letters)
    stem = pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, letters), pa.scalar("*", words.type),
                                       pa.scalar("", words.type))
    return pc.if_else(long, stem, pa.scalar(None, words.type))


def _count(rows: np.ndarray, terms: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) in order, and how often each occurs."""
    keys, counts = np.unique(rows.astype(np.int64) * max(1, n_terms) + terms, return_counts=True)
    return keys // max(1, n_terms), keys % max(1, n_terms), counts


@releasing
def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns doc_id, toxic, text to doc_id, toxic, terms and four min-hashes
    of the 5-word runs."""
    for batch in batches:
        rows, ids, words = terms_of(pc.fill_null(batch.column(2), ""))
        n = batch.num_rows
        names, both_rows, both = words, [rows], [ids]
        for letters in STEMS:
            stems = _stems(words, letters).dictionary_encode()
            at = pc.fill_null(stems.indices, -1).to_numpy()[ids].astype(np.int64)
            both_rows.append(rows[at >= 0])
            both.append(at[at >= 0] + len(names))
            names = pa.concat_arrays([names, stems.dictionary])
        both_rows, both = np.concatenate(both_rows), np.concatenate(both)
        r, t, _ = _count(both_rows, both, len(names))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=n))])
        word_hash = np.array([hash_bytes(w) for w in words.to_pylist()], dtype=np.uint64)
        own = word_hash[ids] if len(ids) else np.zeros(0, np.uint64)
        hashes = np.zeros((n, 4), dtype=np.int64)
        ends = np.cumsum(np.bincount(rows, minlength=n))
        starts = ends - np.bincount(rows, minlength=n)
        for i in range(n):
            run = own[starts[i]:ends[i]]
            runs = [run[k:len(run) - 4 + k] for k in range(5)] if len(run) >= 5 else [run[:1]] * 5
            mixed = np.zeros(len(runs[0]), np.uint64)
            for x in runs:
                mixed = (mixed ^ x) * np.uint64(0x9E3779B97F4A7C15)
            for k in range(4):
                h = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
                hashes[i, k] = np.int64(h.min() >> np.uint64(1)) if len(h) else -1 - k
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names.take(pa.array(t)).cast(pa.string())),
            pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * 4, pa.int32()), pa.array(hashes.ravel()))],
            names=["doc_id", "toxic", "terms", "hashes"])


def hash_bytes(word: str) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(word.encode())


def _feature_counts(names: list[str]):
    """Columns doc_id, text to doc_id and the counts of the features held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names, pa.large_string())
        for batch in batches:
            rows, ids, words = terms_of(pc.fill_null(batch.column(1), ""))
            n = batch.num_rows
            found_r, found_t = [], []
            for value in (words, *(_stems(words, letters) for letters in STEMS)):
                at = pc.fill_null(pc.index_in(value, value_set=known, skip_nulls=True), -1).to_numpy()
                hit = at[ids] if len(ids) else ids
                found_r.append(rows[hit >= 0])
                found_t.append(hit[hit >= 0])
            r, t, c = _count(np.concatenate(found_r), np.concatenate(found_t), len(names))
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=n))]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.ListArray.from_arrays(offsets, pa.array(t, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(c, pa.int32()))], names=["doc_id", "features", "counts"])
    return run


@dataclass
class Index:
    """Examples as unit rows, in blocks, with each block's largest weights."""
    names: list[str]
    idf: np.ndarray
    rows: np.ndarray  # examples x features
    ids: np.ndarray
    toxic: np.ndarray
    weight: np.ndarray  # labelled rows an example stands for
    prior: float
    curve: tuple[float, float] = (0.0, 1.0)
    maxima: np.ndarray = field(init=False)

    def __post_init__(self):
        # Examples with the same strongest term share blocks, so that few
        # blocks have a large bound.
        order = np.lexsort((self.ids, self.rows.argmax(1) if self.rows.shape[1] else self.ids))
        self.rows, self.ids = self.rows[order], self.ids[order]
        self.toxic, self.weight = self.toxic[order], self.weight[order]
        starts = range(0, len(self.ids), BLOCK)
        self.maxima = np.array([self.rows[s:s + BLOCK].max(0) for s in starts]).reshape(len(starts), self.rows.shape[1])

    def vector(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[features]
        norm = np.sqrt((w * w).sum())
        return w / norm if norm > 0 else w

    def nearest(self, features: np.ndarray, w: np.ndarray, k: int = K, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` examples of largest positive
        cosine (the smaller number first among equals), without ``skip``."""
        bound = self.maxima[:, features] @ w
        at, cos, worst = np.zeros(0, np.int64), np.zeros(0), 0.0
        for block in np.argsort(-bound, kind="stable"):
            # An equal bound may still hold an equal cosine of a smaller number.
            if bound[block] <= 0 or (len(at) == k and bound[block] < worst - 1e-12):
                break
            start = block * BLOCK
            own = self.rows[start:start + BLOCK][:, features] @ w
            ids = start + np.flatnonzero(own > 0)
            own = own[own > 0]
            at, cos = np.concatenate([at, ids[ids != skip]]), np.concatenate([cos, own[ids != skip]])
            best = np.lexsort((at, -np.round(cos, 12)))[:k]
            at, cos = at[best], cos[best]
            worst = cos[-1] if len(cos) else 0.0
        return at, cos

    def vote(self, at: np.ndarray, cos: np.ndarray) -> float:
        """Log odds of the neighbours' votes, with one vote for the prior."""
        w = self.weight[at] / (1 - np.minimum(cos, 1.0) + SOFT)
        unit = self.weight.mean() if len(self.weight) else 1.0
        yes, no = (w * self.toxic[at]).sum(), (w * (1 - self.toxic[at])).sum()
        return float(np.log(yes + unit * self.prior) - np.log(no + unit * (1 - self.prior)))

    def score(self, at: np.ndarray, cos: np.ndarray) -> float:
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a + b * self.vote(at, cos)))))

    def calibrate(self) -> None:
        """Fit the logistic curve on leave-one-out votes, each example counted
        for the rows it stands for; a weak pull towards (0, 1) keeps it finite
        where the votes separate the classes."""
        x = []
        for i in range(len(self.ids)):
            features = np.flatnonzero(self.rows[i])
            x.append(self.vote(*self.nearest(features, self.rows[i, features], skip=i)))
        x, y, weight = np.array(x), self.toxic.astype(float), self.weight / max(self.weight.mean(), 1e-9)
        if not len(x) or y.min() == y.max():
            return
        theta, start = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        z = np.stack([np.ones_like(x), x], 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ theta, -40, 40)))
            gradient = z.T @ (weight * (y - p)) - (theta - start)
            hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            theta = theta + np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.curve = (float(theta[0]), float(max(theta[1], 0.0)))


def train_rows(docs_or_labels: DataFrame, folds: int = 5) -> DataFrame:
    return docs_or_labels.filter(F.crc32(F.col("doc_id").cast("string")) % folds != 0)


def fit(docs: DataFrame, labels: DataFrame, staging: Staging, examples: int = EXAMPLES) -> tuple[Index, DataFrame]:
    """The index, and the staged feature counts of every document."""
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    known = (train_rows(labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)"))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # Twice as many as needed: copies are thinned out below. The 4 * examples
    # ids stay a staged table: one made of local rows starts Python workers of
    # its own on every executor.
    sample = None
    for toxic in (0, 1):
        part = known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * examples)
        sample = part if sample is None else sample.unionAll(part)
    ids = staging.write(sample.select(F.col("doc_id").cast("long"), "toxic"), "ids")
    rows = (docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids), "doc_id")
            .select("doc_id", "toxic", "text")
            .mapInArrow(_sample_terms, "doc_id long, toxic int, terms array<string>, hashes array<long>"))
    rows = staging.write(rows, "sample")
    seen = rows.dropDuplicates(["doc_id"])
    for k in range(4):  # of rows that share a min-hash only the first stays
        seen = seen.withColumn("__first", F.min("doc_id").over(Window.partitionBy(F.col("hashes")[k]))) \
            .filter("doc_id = __first").drop("__first")
    seen = (seen.withColumn("__no", F.row_number().over(
                Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")))
            .filter(F.col("__no") <= examples).drop("__no"))
    seen = staging.write(seen.select("doc_id", "toxic", "terms"), "examples")
    picked = seen.select("doc_id", "toxic").collect()
    n1 = sum(r["toxic"] for r in picked)
    n = len(picked)
    with_term = F.col("a") + F.col("b")
    off = F.col("a") * (F.lit(n - n1) - F.col("b")) - F.col("b") * (F.lit(n1) - F.col("a"))
    chi2 = F.lit(n) * off * off / (F.lit(max(1, n1 * (n - n1))) * with_term * (F.lit(n) - with_term))
    chosen = (seen.select("toxic", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
              .filter(with_term < n).withColumn("chi2", chi2).filter(F.col("chi2") >= CHI2)
              .orderBy(F.desc("chi2"), "term").limit(FEATURES).collect()) if n else []
    names = [r["term"] for r in chosen]
    counted = staging.write(
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(releasing(_feature_counts(names)), "doc_id long, features array<int>, counts array<int>"), "counts")
    n_docs = counted.count()
    df = np.zeros(len(names))
    for r in counted.select(F.explode("features").alias("f")).groupBy("f").count().collect():
        df[r["f"]] = r["count"]
    idf = np.log((1 + n_docs) / (1 + df))
    matrix, order = np.zeros((n, len(names))), {r["doc_id"]: i for i, r in enumerate(picked)}
    held = {r["doc_id"]: r for r in counted.filter(F.size("features") > 0)
            .join(F.broadcast(seen.select("doc_id")), "doc_id").dropDuplicates(["doc_id"]).collect()}
    for i, r in held.items():
        f, c = np.array(r["features"]), np.array(r["counts"])
        w = (1 + np.log(c)) * idf[f]
        norm = np.sqrt((w * w).sum())
        matrix[order[i], f] = w / norm if norm > 0 else w
    toxic = np.array([r["toxic"] for r in picked], dtype=np.int64)
    per = {0: totals.get(0, 0) / max(1, n - n1), 1: totals.get(1, 0) / max(1, n1)}
    index = Index(names, idf, matrix, np.array([r["doc_id"] for r in picked], dtype=np.int64), toxic,
                  np.array([per[t] for t in toxic], dtype=float),
                  (totals.get(1, 0) + 1) / (sum(totals.values()) + 2))
    index.calibrate()
    return index, counted


def _scorer(index: Index):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, near = [], []
            for f, c in zip(batch.column(1), batch.column(2)):
                f, c = f.values.to_numpy(), c.values.to_numpy()
                at, cos = index.nearest(f, index.vector(f, c)) if len(f) else (np.zeros(0, np.int64), np.zeros(0))
                scores.append(index.score(at, cos))
                near.append([{"doc_id": int(index.ids[i]), "toxic": int(index.toxic[i]), "cosine": float(s)}
                             for i, s in zip(at, cos)])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(scores, pa.float64()),
                pa.array(near, pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()),
                                                   ("cosine", pa.float64())])))], names=["doc_id", "score", "evidence"])
    return run


def _keeper(index: Index, text_at: int):
    """All columns to the rows that are not predicted toxic."""
    count = _feature_counts(index.names)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_at).cast(pa.string())
            found = next(count(iter([pa.RecordBatch.from_arrays([text, text], names=["doc_id", "text"])])))
            keep = [len(f) == 0 or index.score(*index.nearest(f.values.to_numpy(), index.vector(
                f.values.to_numpy(), c.values.to_numpy()))) < 0.5 for f, c in zip(found.column(1), found.column(2))]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """``docs`` without the rows that ``score_toxicity`` predicts to be toxic,
    with all their columns, decided where the rows are. A document without any
    indexed term stays."""
    index, _ = fit(docs, labels, Staging(docs.sparkSession, "toxicity"), examples)
    return docs.mapInArrow(_keeper(index, docs.columns.index("text")), docs.schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, evidence``.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic. Only labels
    whose crc32(doc_id as text) mod 5 is not 0 are learnt from; ``held_out``
    marks the others. ``score`` is a probability of label 1, ``predicted`` 1
    from 0.5 on. ``evidence`` lists the nearest examples, largest cosine
    first. A document without any indexed term (an empty or null text among
    them) has no neighbours and gets the score of the prior alone. A document
    labelled twice counts as toxic if one label says so; unlabelled and null
    ids teach nothing; without labels every score is the prior of one half.
    """
    index, counted = fit(docs, labels, Staging(docs.sparkSession, "toxicity"), examples)
    scored = counted.mapInArrow(_scorer(index), "doc_id long, score double, "
                                "evidence array<struct<doc_id:long,toxic:int,cosine:double>>")
    return scored.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
