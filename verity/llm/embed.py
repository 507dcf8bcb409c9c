"""Embedding near-duplicates over a robust-pruned flat graph.

Vectors with equal components are one node with a weight. Medoids fitted on a
bounded sample divide the nodes into clusters; every node joins its
``OVERLAP`` nearest ones. A cluster is cut into shards of bounded size, and a
robust-pruned graph is built inside each: a node keeps a near neighbour only if
no kept one is much closer to it, and some far ones, which makes the graph
searchable. The adjacency lists of all shards a node is in are united into one
flat graph.

Every node then searches the shards of its clusters: greedily from the shard's
medoids (its own, and one of each group too large for its members' lists) with
a beam, and, once inside the range, through every node in range
(the beam expands with the result). What is found is verified by the cosine in
double precision. A pair that shares several clusters counts in the smallest
one, so counts add up without listing pairs: a task returns one row a member,
with its number of links and its local component.

Only vectors of one length can be compared. Each length of more than ``SHARD``
nodes has medoids and clusters of its own; a rarer one is one cluster of one
shard.

Recall is audited against brute force on a bounded sample of nodes, half of
them with links found; with less than ``TARGET`` of all links, or ``LEAST`` as
the mean over nodes, the search is repeated with twice the beam and one more
cluster a node. If either stays below ``LEAST`` the query fails.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import Staging, bound_arrow_batches
from verity.llm.components import components

COSINE = 0.9
SAMPLE = 8192  # vectors the medoids are fitted on
MEDOIDS = 1024  # most clusters
PER_CLUSTER = 1000  # members aimed at
SHARD = 1024  # most nodes in a shard, about
OVERLAP = 4
DEGREE = 24
NEAR, FAR = 40, 12  # candidates of a node: nearest, and spread over the shard
ALPHA = 1.2
BEAM = 16
AUDIT = 256  # nodes compared with all others
TARGET = 0.98
LEAST = 0.9

NODE = "vec_id long, d1 long, d2 long, v binary"


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, components to the unit vector in double precision and a digest
    of it; null where a vector can link with nothing."""
    import xxhash
    for batch in batches:
        v, d = [], []
        for x in batch.column(1):
            x = None if x.as_py() is None or x.values.null_count else x.values.to_numpy().astype(np.float64)
            norm = 0.0
            if x is not None and len(x) and np.isfinite(x).all():
                x = x / np.abs(x).max() if np.abs(x).max() > 0 else x  # no overflow in the squares
                norm = math.sqrt(float((x * x).sum()))
            blob = (x / norm + 0.0).tobytes() if norm > 0 else None
            v.append(blob)
            h = xxhash.xxh3_128_intdigest(blob) if blob else 0
            d.append((h >> 64, h & 0xFFFFFFFFFFFFFFFF))
        halves = np.array(d, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                                          pa.array(v, pa.binary())], names=["vec_id", "d1", "d2", "v"])


def matrix(column) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1) if blobs else np.zeros((0, 0))


def fit_medoids(sample: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Spherical k-means from the sample's first rows; the medoid of a cluster
    is the sample row nearest to its mean."""
    centres = sample[:k]
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
    return sample[np.unique((centres @ sample.T).argmax(1))]


def _assign(medoids: np.ndarray, overlap: int):
    """rep, copies, v to one row for each of the node's clusters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            near = matrix(batch.column(2)) @ medoids.T if n else np.zeros((0, len(medoids)))
            k = min(overlap, len(medoids))
            own = np.sort(np.argpartition(-near, k - 1, axis=1)[:, :k], axis=1).astype(np.int32)
            at = pa.array(np.repeat(np.arange(n), k))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(own.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.ravel()), *(c.take(at) for c in (*batch.columns, lists))],
                names=["cluster", "rep", "copies", "v", "clusters"])
    return run


def robust_prune(node: int, candidates: np.ndarray, near: np.ndarray, degree: int = DEGREE) -> list[int]:
    """Neighbours of ``node`` among ``candidates``: nearest first, dropping a
    candidate that a kept one is ``ALPHA`` times closer to."""
    left = candidates[np.argsort(-near[node, candidates], kind="stable")]
    kept = []
    while len(left) and len(kept) < degree:
        best, left = left[0], left[1:]
        kept.append(int(best))
        left = left[ALPHA * (1 - near[best, left]) > 1 - near[node, left]]
    return kept


def build_graph(vectors: np.ndarray) -> list[list[int]]:
    """Robust-pruned adjacency lists of one shard, with reverse edges."""
    n = len(vectors)
    near = vectors @ vectors.T
    np.fill_diagonal(near, -2.0)
    k = min(NEAR, n - 1)
    nearest = np.argpartition(-near, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((n, 0), np.int64)
    far = (np.arange(n)[:, None] + 1 + (np.arange(FAR) * max(1, n // FAR))[None, :]) % n
    lists = []
    for i in range(n):
        c = np.unique(np.concatenate([nearest[i], far[i]]))
        lists.append(robust_prune(i, c[c != i], near))
    back: list[list[int]] = [[] for _ in range(n)]
    for i, own in enumerate(lists):
        for j in own:
            back[j].append(i)
    for i in range(n):
        both = np.unique(np.array(lists[i] + back[i], np.int64))
        lists[i] = [int(x) for x in both] if len(both) <= DEGREE else robust_prune(i, both, near)
    return lists


def _build(table: pa.Table) -> pa.Table:
    reps = table["rep"].to_numpy()
    order = np.argsort(reps)
    vectors = matrix(table["v"])[order]
    lists = build_graph(vectors)
    return pa.table({"rep": reps[order], "near": pa.array([reps[order][x].tolist() for x in lists], pa.list_(pa.int64()))})


def entries(nodes: np.ndarray, table: np.ndarray) -> list[int]:
    """Where searches begin: the shard's medoid, and the medoid of every group
    of more than ``DEGREE`` nodes that edges in range connect. The members of
    so large a group may fill their lists with each other, and then no edge
    need lead there."""
    out = [int((nodes @ nodes.mean(0)).argmax())]
    a, at = np.nonzero(table >= 0)
    b = table[a, at]
    close = np.zeros(len(a), bool)
    for i in range(0, len(a), 65536):
        part = slice(i, i + 65536)
        close[part] = np.einsum("ij,ij->i", nodes[a[part]], nodes[b[part]]) >= COSINE
    label = local_components(len(nodes), a[close], b[close])
    for group in np.flatnonzero(np.bincount(label, minlength=len(nodes)) > DEGREE):
        own = np.flatnonzero(label == group)
        out.append(int(own[(nodes[own] @ nodes[own].mean(0)).argmax()]))
    return sorted(set(out))


def search(queries: np.ndarray, nodes: np.ndarray, lists: list[np.ndarray], beam: int) -> np.ndarray:
    """Boolean queries x nodes: the nodes in range that a greedy search from
    the medoids reaches. All queries advance together; in each round a query
    opens its best unopened nodes while they are within its beam, and every
    unopened node in range."""
    q, n = len(queries), len(nodes)
    if not q or not n:
        return np.zeros((q, n), bool)
    width = max(1, max(len(x) for x in lists))
    table = np.full((n, width), -1, np.int64)
    for i, x in enumerate(lists):
        table[i, :len(x)] = x
    near = np.full((q, n), -2.0)
    opened = np.zeros((q, n), bool)
    start = entries(nodes, table)
    near[:, start] = queries @ nodes[start].T
    active = np.arange(q)
    while len(active):
        seen = near[active]
        k = min(beam, n)
        floor = -np.partition(-seen, k - 1, axis=1)[:, k - 1]
        waiting = np.where(opened[active], -2.0, seen)
        best = waiting.argmax(1)
        top = waiting[np.arange(len(active)), best]
        go = (top > -2.0) & (top >= np.minimum(floor, COSINE))
        open_now = waiting >= COSINE
        open_now[np.flatnonzero(go), best[go]] = True
        row, node = np.nonzero(open_now)
        opened[active[row], node] = True
        # Distinct nodes that the opened ones lead to and that are not seen.
        target = table[node]
        pairs = np.unique((active[row][:, None] * n + target)[target >= 0])
        a, b = pairs // n, pairs % n
        fresh = near[a, b] == -2.0
        a, b = a[fresh], b[fresh]
        for i in range(0, len(a), 65536):
            part = slice(i, i + 65536)
            near[a[part], b[part]] = np.einsum("ij,ij->i", queries[a[part]], nodes[b[part]])
        active = active[go | open_now.any(1)]
    return near >= COSINE


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


PART = "rep long, links long, label long"


def _search(beam: int):
    """The members of two shards of one cluster (side 0 and 1, or only 0):
    each one's links, counted where this cluster is the smallest the pair
    shares, and the smallest id of its local component."""
    def run(table: pa.Table) -> pa.Table:
        cluster = table["cluster"][0].as_py()
        reps, side, copies = (table[c].to_numpy() for c in ("rep", "side", "copies"))
        order = np.lexsort((reps, side))
        reps, side, copies = reps[order], side[order], copies[order]
        vectors = matrix(table["v"])[order]
        clusters = np.array(table["clusters"].to_pylist())[order]
        near = table["near"].combine_chunks().take(pa.array(order))
        # Adjacency inside each side; ids are sorted within a side.
        found_a, found_b = [], []
        sides = [np.flatnonzero(side == s) for s in (0, 1) if (side == s).any()]
        for graph in sides:
            own = reps[graph]
            lists = []
            for i in graph:
                x = near[int(i)].values.to_numpy()
                at = np.minimum(np.searchsorted(own, x), len(own) - 1)
                lists.append(at[own[at] == x])
            for asking in sides:
                if len(sides) == 2 and asking is graph:
                    continue  # that pair of shards has a task of its own
                a, b = np.nonzero(search(vectors[asking], vectors[graph], lists, beam))
                found_a.append(asking[a])
                found_b.append(graph[b])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        n = len(reps)
        both = np.unique(np.concatenate([a * n + b, b * n + a]))
        a, b = both // n, both % n
        a, b = a[a != b], b[a != b]
        label = local_components(n, a, b)
        smaller = np.where(clusters < cluster, clusters, -1)
        elsewhere = np.zeros(len(a), bool)
        for x in range(clusters.shape[1]):
            own = smaller[a, x]
            elsewhere |= (own >= 0) & (clusters[b] == own[:, None]).any(1)
        links = np.bincount(a[~elsewhere], weights=copies[b[~elsewhere]], minlength=n).astype(np.int64)
        return pa.table({"rep": reps, "links": links, "label": reps_min(reps, label)})
    return run


def reps_min(reps: np.ndarray, label: np.ndarray) -> np.ndarray:
    low = reps.copy()
    np.minimum.at(low, label, reps)
    return low[label]


def _audit(vectors: np.ndarray):
    """Weight of the nodes in range of each audited one, by brute force."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vectors), np.int64)
        for batch in batches:
            if batch.num_rows:
                hit = vectors @ matrix(batch.column(1)).T >= COSINE
                total += (hit * batch.column(0).to_numpy()[None, :]).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vectors))), pa.array(total)], names=["i", "links"])
    return run


MEMBER = "cluster int, rep long, copies long, v binary, clusters array<int>"


def _members(nodes: DataFrame, common: list[tuple[int, int]], overlap: int) -> DataFrame:
    """One row for each cluster of a node. ``common``: the lengths (in bytes)
    of more than ``SHARD`` nodes, with their number of nodes; at most nodes /
    SHARD of them. The clusters of each have numbers of their own."""
    rare = nodes.filter(~F.col("n_bytes").isin([length for length, _ in common]))
    out = rare.select((-F.col("n_bytes")).alias("cluster"), "rep", "copies", "v",
                      F.array(-F.col("n_bytes")).alias("clusters"))
    for i, (length, n) in enumerate(common):
        mine = nodes.filter(F.col("n_bytes") == length).select("rep", "copies", "v")
        sample = mine.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("v").toArrow()
        k = max(1, min(MEDOIDS, math.ceil(n * overlap / PER_CLUSTER), sample.num_rows))
        assigned = mine.mapInArrow(_assign(fit_medoids(matrix(sample["v"]), k), overlap), MEMBER)
        shift = lambda c: c + F.lit(i * MEDOIDS)  # noqa: E731, B023 - used at once
        out = out.unionByName(assigned.withColumns({"cluster": shift(F.col("cluster")),
                                                    "clusters": F.transform("clusters", shift)}))
    return out


def _found(nodes: DataFrame, common: list[tuple[int, int]], overlap: int, beam: int, staging: Staging,
           name: str) -> DataFrame:
    """rep, links (without the node's own copies), label: one row a node and task."""
    members = staging.write(_members(nodes, common, overlap), f"{name}-members")
    shards = (members.filter("cluster >= 0").groupBy("cluster")
              .agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards")))
    placed = (members.join(F.broadcast(shards), "cluster", "left")  # at most MEDOIDS rows a common length
              .withColumn("shards", F.coalesce("shards", F.lit(1)))
              .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int")))
    lists = placed.groupBy("cluster", "own").applyInArrow(_build, "rep long, near array<long>")
    flat = staging.write(lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")),
                         f"{name}-graph")
    meets = F.transform(F.sequence(F.lit(0), F.col("shards") - 1), lambda j: F.struct(
        F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j"),
        F.when(j < F.col("own"), 1).otherwise(0).alias("side")))
    met = (placed.join(flat, "rep").withColumn("m", F.explode(meets))
           .select("cluster", F.col("m.i").alias("i"), F.col("m.j").alias("j"), F.col("m.side").alias("side"),
                   "rep", "copies", "v", "clusters", "near"))
    return staging.write(met.groupBy("cluster", "i", "j").applyInArrow(_search(beam), PART), f"{name}-found")


def _exact(nodes: DataFrame, found: DataFrame, lengths: list[int], audit: int) -> dict[int, int]:
    """Links of up to ``audit`` nodes of each length by brute force (without
    the node's own copies): half of them with links found, half any."""
    out: dict[int, int] = {}
    linked = found.filter("links > 0").select("rep").distinct()
    for length in lengths:
        mine = nodes.filter(F.col("n_bytes") == length)
        picked = [side.orderBy(F.xxhash64(F.lit(1), "rep"), "rep").limit(-(-audit // 2))
                  for side in (mine, mine.join(linked, "rep", "left_semi"))]
        asked = picked[0].unionByName(picked[1]).dropDuplicates(["rep"]).select("rep", "copies", "v").toArrow()
        if not asked.num_rows:
            continue
        totals = dict(mine.select("copies", "v").mapInArrow(_audit(matrix(asked["v"])), "i long, links long")
                      .groupBy("i").agg(F.sum("links")).collect())
        for i, (rep, copies) in enumerate(zip(asked["rep"].to_pylist(), asked["copies"].to_pylist())):
            out[rep] = totals[i] - copies
    return out


def _recall(found: DataFrame, exact: dict[int, int]) -> tuple[float, float] | None:
    """Share of the audited links that were found: of all, and the mean over
    the nodes that have any, so that neither one large group nor many small
    ones hides a loss. None without any link."""
    want = {rep: n for rep, n in exact.items() if n}
    if not want:
        return None
    got = {r["rep"]: r["n"] for r in found.filter(F.col("rep").isin(list(want))).groupBy("rep")
           .agg(F.sum("links").alias("n")).collect()}
    hit = {rep: min(got.get(rep, 0), n) for rep, n in want.items()}
    return sum(hit.values()) / sum(want.values()), sum(hit[rep] / n for rep, n in want.items()) / len(want)


def near_duplicate_vectors(vectors: DataFrame, audit: int = AUDIT, staging: Staging | None = None) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept, recall``.

    Vectors link when their cosine in double precision is at least 0.9 and the
    search finds them; ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest vec_id reachable and the one ``kept``.
    ``recall`` is the audited share of the links (null when the audited nodes
    have none); below 0.9 the query fails. Vectors of different lengths do not
    link. A vector that is null, empty or zero, or holds null or non-finite
    components, links with nothing. Rows with equal directions are copies and
    link; rows that share a vec_id are rows of their own. A null vec_id links
    with nothing. An empty table gives no rows. Other columns are not read,
    whatever their names.
    """
    spark = vectors.sparkSession
    bound_arrow_batches(spark)
    staging = staging or Staging(spark, "vectors")
    rows = staging.write(vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_normalise, NODE), "rows")
    usable = rows.filter("v IS NOT NULL AND vec_id IS NOT NULL")
    # A node is a direction; its number is settled by the write, its label is
    # the smallest vec_id.
    nodes = usable.groupBy("d1", "d2").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.min("v").alias("v"))
    nodes = staging.write(nodes.withColumns({"n_bytes": F.octet_length("v"), "rep": F.monotonically_increasing_id()}), "nodes")
    sizes = nodes.groupBy("n_bytes").agg(F.count("*").alias("n"))
    common = sorted(tuple(r) for r in sizes.filter(F.col("n") > SHARD).collect())
    most = sizes.orderBy(F.desc("n"), "n_bytes").limit(1).collect()
    audited = [length for length, _ in common] or [r.n_bytes for r in most]
    overlap, beam, recall, exact = OVERLAP, BEAM, None, None
    found = spark.createDataFrame([], PART)
    while most:
        found = _found(nodes, common, overlap, beam, staging, f"try-{overlap}")
        exact = _exact(nodes, found, audited, audit) if exact is None else exact
        shares = _recall(found, exact)
        recall = min(shares) if shares else None
        if shares is None or (shares[0] >= TARGET and recall >= LEAST) or overlap >= 2 * OVERLAP:
            break
        overlap, beam = overlap + 1, 2 * beam
    if recall is not None and recall < LEAST:
        raise RuntimeError(f"audited recall {recall:.3f} is below {LEAST}")
    total = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.filter("rep <> label").select(F.col("rep").alias("a"), F.col("label").alias("b")), staging)
    joined = (nodes.select("d1", "d2", "rep", "copies", "least").join(total, "rep", "left")
              .join(groups.withColumnRenamed("id", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    smallest = joined.groupBy("component").agg(F.min("least").alias("label"))
    named = joined.join(smallest, "component").select(
        "d1", "d2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("label").alias("component"))
    linked = F.col("v").isNotNull() & F.col("vec_id").isNotNull()
    return (rows.withColumn("linked", linked).join(named, ["d1", "d2"], "left")
            .select("vec_id", F.when(F.col("linked"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
                    F.when(F.col("linked"), F.col("component")).otherwise(F.col("vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
            .withColumn("recall", F.lit(recall).cast("double")))
