"""Token counts, fill-in-the-middle and centroid clustering against the
library, plain Python and exact integers, and on edge rows."""
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.llm import centroids, counts, fim
from verity.llm.queries import tokenizer_path

DATA = "/root/testdata/sf0.001"
PATH = "byte_bpe_50k.json"
ODD = ["<|endoftext|>", "<|endoftext|", "'s", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "é", "²", "日本",
       "՘", "\U00010940", "\U0001F600", "a", "B", "foo", "123", "!!", "�", "́", "½", "<P>", "<S>", "<M>", "<", "P>"]
LONG = " ".join(f"word{i % 977}x" for i in range(20_000))


def odd_texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append("".join(
            rng.choice(ODD) if rng.random() < 0.7
            else chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]))
            for _ in range(rng.randrange(14))))
    return out + ["", " ", "\n\n\n", "ab" * 30_000 + "x" * 20_000, LONG, " " * 5_000, "é" * 5_000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(PATH))
    t.no_truncation()
    t.no_padding()
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def texts(spark):
    """id and text of rows with nulls, repeats, odd and long texts, and of the table."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(odd_texts(1500, 5))]
    return rows + [(7, None), (7, None), (None, "no id"), (None, None), (8, "same"), (8, "same"), (8, "other")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for name in ("n", "form", "output", "h1", "n_tokens", "over_limit", "restored", "x", "cluster"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def test_counts_equal_the_library(docs, texts, library):
    out = counts.token_counts(docs, tokenizer_path(PATH)).collect()
    found = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out)
    want = sorted((str(i), len((t or "").encode()), n, n > 512) for i, t in texts for n in [library(t or "")])
    assert found == want


def test_counts_with_little_room_to_remember(library, monkeypatch):
    monkeypatch.setattr(counts, "REMEMBERED", 2_000)
    monkeypatch.setattr(counts, "LONG_TEXT", 50)
    c = counts.Counter(tokenizer_path(PATH))
    for t in odd_texts(300, 6):
        assert c.count(t) == library(t)


def test_merges_one_pair_at_a_time():
    """The heap's merges against the definition: the leftmost pair of least rank, again and again."""
    import json
    with open(tokenizer_path(PATH), encoding="utf-8") as f:
        spec = json.load(f)
    rank = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(spec["model"]["merges"])}
    symbols, merges = counts.byte_symbols(), counts.Merges(spec)
    rng = random.Random(9)
    for _ in range(300):
        word = "".join(rng.choice("aabehnrst ée") for _ in range(rng.randrange(40))).encode()
        parts = [symbols[b] for b in word]
        while True:
            best = min(((rank.get(p, math.inf), i) for i, p in enumerate(zip(parts, parts[1:]))), default=(math.inf, 0))
            if best[0] == math.inf:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert merges.count(word) == len(parts)


def test_counts_refuse_other_vocabularies():
    with pytest.raises(ValueError):
        counts.Counter(tokenizer_path("word_bpe_49k.json"))


def middle(i, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("slice_bytes", [fim.SLICE, 500])
def test_fim_equals_plain_python_and_restores(docs, texts, slice_bytes, monkeypatch):
    monkeypatch.setattr(fim, "SLICE", slice_bytes)
    out = fim.restored(fim.fill_in_middle(docs)).collect()
    found = sorted((str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), r.output, r.restored) for r in out)
    want = []
    for i, t in texts:
        n, form, p, m, output = middle(i, t or "")
        want.append((str(i), n, form, str(p), str(m), output, t or ""))
    assert found == sorted(want)
    assert {"plain", "psm", "spm"} <= {r.form for r in out}


def test_fim_shares_are_parameters(docs):
    assert {r.form for r in fim.fill_in_middle(docs, rearranged=0).select("form").distinct().collect()} == {"plain"}
    assert "psm" not in {r.form for r in fim.fill_in_middle(docs, suffix_first=100).select("form").distinct().collect()}


def test_empty_documents(docs):
    assert counts.token_counts(docs.filter("false"), tokenizer_path(PATH)).collect() == []
    assert fim.restored(fim.fill_in_middle(docs.filter("false"))).collect() == []


def clusters(rows, k, dims, rounds):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                     r[0] is not None, r[0] or 0, r[1])
    centres = [x for _, x in sorted(kept, key=key)[:k]]

    def nearest():
        out = []
        for _, x in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(x, m)), c) for c, m in enumerate(centres)))
        return out

    for _ in range(rounds):
        found = nearest()
        for c in range(len(centres)):
            members = [x for (_, x), (_, at) in zip(kept, found) if at == c]
            if members:
                centres[c] = [sum(col) // len(members) for col in zip(*members)]
    found = nearest() if kept else []
    per = {}
    for d, c in found:
        per[c] = per.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in centres]
    return sorted((str(i), c, d, per[c], sum(per.values()), digest[c]) for (i, _), (d, c) in zip(kept, found))


def vectors(n, dims, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(rng.choice([-1, 1]), 0.3) for _ in range(dims)]) for i in range(n)]
    same = [0.5] * dims
    return rows + [(i, same) for i in range(n, n + n // 2)] + [
        (None, same), (None, [1.0] * dims), (3, [2.0] * dims), (3, [2.0] * dims), (9001, None), (9002, []),
        (9003, [0.1] * (dims - 1)), (9004, [0.1] * (dims + 1)), (9005, [None] + [0.1] * (dims - 1)),
        (9006, [float("nan")] + [0.1] * (dims - 1)), (9007, [float("inf")] + [0.1] * (dims - 1)), (9008, [0.0] * dims)]


SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("x", T.StringType()), T.StructField("cluster", T.StringType())])


@pytest.mark.parametrize("n, k, dims, rounds", [(60, 5, 4, 5), (30, 40, 3, 2), (4, 40, 4, 3), (200, 7, 2, 9), (20, 3, 4, 0)])
def test_clusters_equal_plain_python(spark, n, k, dims, rounds):
    rows = vectors(n, dims, n)
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    out = centroids.cluster_vectors(df, k=k, dims=dims, rounds=rounds).collect()
    assert sorted((str(r[0]), *r[1:]) for r in out) == clusters(rows, k, dims, rounds)


def test_clusters_of_the_table(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()][:200]
    out = centroids.cluster_vectors(df.join(spark.createDataFrame([(i,) for i, _ in rows], "vec_id long"), "vec_id")).collect()
    assert sorted((str(r[0]), *r[1:]) for r in out) == clusters(rows, 40, 64, 5)


def test_no_kept_vectors(spark):
    df = spark.createDataFrame([(1, None, "", ""), (2, [1.0], "", "")], SCHEMA)
    assert centroids.cluster_vectors(df).collect() == []
    assert centroids.cluster_vectors(df.filter("false")).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_large_components_fail(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0], "", "")], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster_vectors(df, dims=2).collect()


def test_only_moved_components_are_updated(spark):
    """Products kept through moves equal products computed anew."""
    import numpy as np
    rng = np.random.default_rng(4)
    x = rng.integers(-50, 50, (40, 6))
    old, new = rng.integers(-9, 9, (2, 5, 6))
    new[1], new[3, :4] = old[1], old[3, :4]
    state = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, x array<long>")
    there = centroids.move(centroids.move(state, np.zeros_like(old), old), old, new).collect()
    assert [r.products for r in there] == (x[[r.vec_id for r in there]] @ new.T).tolist()
